"""Column-expression helpers (return ``Column``; no actions)."""

from pansift.functions.numeric import (clip_guarded, finite_or_null, nan_to_null, numeric_types,
                                       safe_div, skew_adjust_factor)
from pansift.functions.text import safe_name, strip_all, strip_symbols_expr

__all__ = ["clip_guarded", "finite_or_null", "nan_to_null", "numeric_types", "safe_div",
           "skew_adjust_factor", "safe_name", "strip_all", "strip_symbols_expr"]
