"""Column-expression helpers (all JVM-side built-ins, codegen friendly)."""

from .numeric import round_half_even, py_round, inverse  # noqa: F401
from .odds import spread_fraction, spread_pct2, overround_pct3  # noqa: F401
from .text import strip_whitespace, has_edge_whitespace, extract_player_id, split_part_int  # noqa: F401
from .lineup import lineup_hash  # noqa: F401
