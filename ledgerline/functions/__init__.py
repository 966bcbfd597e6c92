from .calendar import date_key
from .parsing import parse_money, parse_moment, parse_moment_strict
from .properties import normalised_properties

__all__ = [
    "date_key",
    "normalised_properties",
    "parse_moment",
    "parse_moment_strict",
    "parse_money",
]
