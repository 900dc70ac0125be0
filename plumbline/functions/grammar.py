"""How numbers and dates are written: one grammar, read alike by Java's and by Python's regular expressions.

``values`` makes column expressions of it, ``scalars`` plain functions; neither has rules of its own. Patterns are meant for
stripped text, are anchored, and hold no loop over a group, so that texts of any length are matched in linear time and
without recursion. White space inside a pattern is that of ASCII.
"""

from __future__ import annotations

from dataclasses import dataclass

NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
#: The words that a number parser takes beside it.
INFINITE = r"(?i)^[+-]?inf(inity)?$"
#: Characters that only dress a number, and dashes that stand for a minus.
CURRENCY_SIGNS = "£$€¥"
DASHES = "−–—"

MONTH_STARTS = "janfebmaraprmayjunjulaugsepoctnovdec"
_MONTH = "(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
_WEEKDAY = r"(?:(?:mon|tue|tues|wed|wednes|thu|thur|thurs|fri|sat|satur|sun)(?:day)?,?\s+)?"
_TIME = r"(?:[t\s]+(?:[01]?[0-9]|2[0-3]):[0-5][0-9](?::[0-5][0-9](?:[.,][0-9]+)?)?\s*(?:z|[+-][0-9]{2}:?[0-9]{2}|[ap]m)?)?"
_YEAR = "([0-9]{4}|[0-9]{2})"


@dataclass(frozen=True)
class DateStyle:
    """A writing of dates: its pattern, the groups of year, month and day, and whether day and month may change places."""

    pattern: str
    year: int
    month: int
    day: int
    either_order: bool = False
    named_month: bool = False


def _style(body: str, *groups: int, **kind: bool) -> DateStyle:
    return DateStyle(f"(?i)^{body}$", *groups, **kind)


#: The styles of dates; no two of them fit one text.
DATE_STYLES = (
    _style(r"([0-9]{4})([-/.])([0-9]{1,2})\2([0-9]{1,2})" + _TIME, 1, 3, 4),
    _style("((?:1[6-9]|2[01])[0-9]{2})([0-9]{2})([0-9]{2})", 1, 2, 3),
    _style(r"([0-9]{1,2})([-/. ])([0-9]{1,2})\2" + _YEAR + _TIME, 4, 3, 1, either_order=True),
    _style(_WEEKDAY + r"([0-9]{1,2})(?:st|nd|rd|th)?[-\s./]+" + _MONTH + r"\.?,?[-\s./]+" + _YEAR + _TIME, 3, 2, 1, named_month=True),
    _style(_WEEKDAY + _MONTH + r"\.?[-\s]+([0-9]{1,2})(?:st|nd|rd|th)?,?[-\s]+" + _YEAR + _TIME, 3, 1, 2, named_month=True),
)
#: Years of two digits below this are of this century.
PIVOT_YEAR = 69
