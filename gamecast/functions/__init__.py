"""Scalar column helpers."""

from .scalars import (date_label, escape_name, parse_ymd, round_half_up,  # noqa: F401
                      split_roster, unescape_name)
