"""Role columns and domain constants.

Operators never hard-code a column name: they take a :class:`Roles` (or plain
column-name arguments) so the same code runs on the match exports and on the
driver's test tables (see ``scoutlens.plans.bindings``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results)
# ---------------------------------------------------------------------------
# Feeder leagues, division 1 then division 2, and the top league.
FEEDER_DIV1_LEAGUES = ["LFL", "PRM", "LVP SL", "NLC", "TCL"]
FEEDER_DIV2_LEAGUES = ["LFL2"]
TOP_LEAGUE = "LEC"
FEEDER_LEAGUES = FEEDER_DIV1_LEAGUES + FEEDER_DIV2_LEAGUES
ALL_TARGET_LEAGUES = FEEDER_LEAGUES + [TOP_LEAGUE]
TRAIN_YEARS = [2024]
TEST_YEARS = [2025]
HORIZON_MONTHS = 18
POSITIONS = ["top", "jng", "mid", "bot", "sup"]
MIN_GAMES = 5
SEED = 42
K_RANGE = list(range(3, 12))
MIN_ROWS_TO_CLUSTER = 20
UNKNOWN_ARCHETYPE = "Inconnu"
NEUTRAL_ARCHETYPE = "Profil neutre"

# Match-table columns kept by the column selection step (reference order).
KEY_COLUMNS = [
    "gameid", "league", "split", "date", "position", "playername", "teamname", "champion",
    "result",
    "kills", "deaths", "assists", "killsat15", "deathsat15", "assistsat15", "csat15",
    "csdiffat15", "golddiffat15", "xpdiffat15",
    "totalgold", "earnedgold", "minionkills", "monsterkills", "wardskilled", "wardsplaced",
    "visionscore", "damagetochampions", "damageshare", "killparticipation", "dpm", "cspm",
    "vspm", "earnedgoldshare", "gamelength",
]
OPTIONAL_COLUMNS = ["killparticipation"]
REQUIRED_COLUMNS = [c for c in KEY_COLUMNS if c not in OPTIONAL_COLUMNS]
NUMERIC_CHECK_COLUMNS = [
    "result", "kills", "deaths", "assists", "csdiffat15", "golddiffat15", "xpdiffat15",
    "dpm", "cspm", "vspm", "damageshare", "earnedgoldshare", "gamelength",
]
# Per-split means and z-scored features.
MEAN_COLUMNS = [
    "kills", "deaths", "assists", "killparticipation", "dpm", "cspm", "vspm",
    "golddiffat15", "csdiffat15", "xpdiffat15", "damageshare", "earnedgoldshare",
]
ZSCORE_BASE = [
    "killparticipation", "dpm", "cspm", "vspm", "golddiffat15", "csdiffat15",
    "xpdiffat15", "win_rate", "champion_pool_size",
]
# Model features (12) and clustering features (9), reference order.
MODEL_FEATURES = [
    "killparticipation_zscore", "dpm_zscore", "cspm_zscore", "vspm_zscore",
    "golddiffat15_zscore", "csdiffat15_zscore", "xpdiffat15_zscore", "win_rate_zscore",
    "champion_pool_size_zscore", "win_rate", "games_played", "champion_pool_size",
]
CLUSTER_FEATURES = [
    "dpm_zscore", "cspm_zscore", "vspm_zscore", "killparticipation_zscore",
    "golddiffat15_zscore", "xpdiffat15_zscore", "csdiffat15_zscore",
    "champion_pool_size_zscore", "win_rate_zscore",
]
# Archetype rules, in order: (label, [(feature, threshold), ...]) all strict ">",
# conjunction inside a rule; the balanced rule is |x| < 0.15 on the first five
# clustering features.
ARCHETYPE_RULES = [
    ("Carry agressif", [("dpm_zscore", 0.3), ("killparticipation_zscore", 0.3)]),
    ("High DPS", [("dpm_zscore", 0.5)]),
    ("Farmer dominant", [("cspm_zscore", 0.3), ("golddiffat15_zscore", 0.2)]),
    ("Lane bully", [("csdiffat15_zscore", 0.4)]),
    ("Vision controller", [("vspm_zscore", 0.5)]),
    ("Early dominant", [("xpdiffat15_zscore", 0.3), ("golddiffat15_zscore", 0.3)]),
    ("Versatile", [("champion_pool_size_zscore", 0.5)]),
    ("High performer", [("win_rate_zscore", 0.5)]),
]
BALANCED_LABEL = "Profil équilibré"
BALANCED_LIMIT = 0.15
BALANCED_FEATURES = CLUSTER_FEATURES[:5]
LABEL_SEPARATOR = " | "
# Model hyper-parameters.
LR_C = 0.1
LR_MAX_ITER = 1000
RF_TREES = 200
RF_DEPTH = 10
GBT_ROUNDS = 200
GBT_DEPTH = 6
GBT_STEP = 0.1
CALIBRATION_FOLDS = 5
SEARCH_DRAWS = 60
SEARCH_FOLDS = 5
# Search space of the forest's randomised search (fixed values; 30 levels stand for "unlimited").
RF_GRID = {
    "num_trees": [100, 200, 300, 500, 700],
    "max_depth": [4, 6, 8, 10, 12, 15, 30],
    "min_split": [2, 5, 10, 20, 30],
    "min_leaf": [1, 2, 4, 8],
    "features": ["sqrt", "log2", "0.3", "0.5", "0.7"],
    "class_weight": ["balanced", "balanced_subsample"],
}
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Roles:
    """Names of the role columns of a match-like table."""

    gameid: str = "gameid"
    league: str = "league"
    year: str = "_source_year"
    split: str = "split"
    date: str = "date"
    position: str = "position"
    player: str = "playername"
    original: str = "playername_original"
    team: str = "teamname"
    champion: str = "champion"
    result: str = "result"
    kills: str = "kills"
    assists: str = "assists"
    target: str = "promoted_to_lec"
    feeders: tuple = field(default_factory=lambda: tuple(FEEDER_LEAGUES))
    top: str = TOP_LEAGUE

    @property
    def split_keys(self) -> list[str]:
        """Grain of the player-split feature table."""
        return [self.player, self.league, self.year, self.split, self.position, self.team]

    @property
    def peer_keys(self) -> list[str]:
        """Peer group of the z-scores."""
        return [self.league, self.year, self.split, self.position]


DEFAULT_ROLES = Roles()
