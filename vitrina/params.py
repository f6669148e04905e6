"""Run parameters of the feature job (campaign windows, category, options)."""

from __future__ import annotations

from dataclasses import dataclass, replace

from . import codes


@dataclass(frozen=True)
class Params:
    """One run of the job: one category or several at once, a closed and an open campaign window.

    Campaign codes are fixed-width ``YYYYCC`` strings and compare as strings.  With ``categories`` one run gives the rows of all of them, each
    numbered and corrected by itself, as if there had been a run for each.  ``part_from`` and ``part_to`` limit the campaigns whose rows are made;
    the windows keep their meaning.
    """

    closed_from: str = "201401"
    closed_to: str = "201714"
    open_from: str = "201715"
    open_to: str = "201806"
    category: str = codes.CATEGORIES[0]
    development_to: str = "201710"
    # Raise instead of returning null for unparsable exposure texts and zero order counts.
    strict: bool = False
    categories: tuple[str, ...] = ()
    part_from: str = "000000"
    part_to: str = "999999"
    # Bits of the key filters of the run's products at the fact scans, a power of two; for product tables beyond the broadcast limit.
    key_filter_bits: int | None = None

    def __post_init__(self):
        for name in ("closed_from", "closed_to", "open_from", "open_to", "development_to", "part_from", "part_to"):
            value = getattr(self, name)
            if len(value) != 6 or not value.isdigit():
                raise ValueError(f"{name} must be a YYYYCC campaign code, got {value!r}")
        if self.closed_from > self.closed_to or self.open_from > self.open_to:
            raise ValueError("campaign window with start after end")
        if self.closed_from <= self.open_to and self.open_from <= self.closed_to:
            raise ValueError("closed and open campaign windows overlap")
        if len(set(self.categories)) < len(self.categories):
            raise ValueError("a category is named twice")

    @property
    def run_categories(self) -> tuple[str, ...]:
        return self.categories or (self.category,)

    def _part(self, first: str, last: str) -> tuple[str, str]:
        """What of a window is asked for; empty (first > last) if nothing is."""
        return (max(first, self.part_from), min(last, self.part_to))

    @property
    def closed(self) -> tuple[str, str]:
        """Closed campaigns whose rows are made."""
        return self._part(self.closed_from, self.closed_to)

    @property
    def open(self) -> tuple[str, str]:
        """Open campaigns whose rows are made."""
        return self._part(self.open_from, self.open_to)

    @property
    def span(self) -> tuple[str, str]:
        """Window of estimates and support pairs: start of closed to end of open."""
        return self._part(self.closed_from, self.open_to)

    @property
    def whole(self) -> tuple[str, str]:
        """Both windows and what lies between them."""
        return self._part(self.all_from, self.all_to)

    @property
    def all_from(self) -> str:
        return min(self.closed_from, self.open_from)

    @property
    def all_to(self) -> str:
        return max(self.closed_to, self.open_to)

    def max_campaigns(self) -> int:
        """Upper bound of distinct campaign codes in [all_from, all_to]: 100 per year."""
        return (int(self.all_to[:4]) - int(self.all_from[:4]) + 1) * 100

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)
