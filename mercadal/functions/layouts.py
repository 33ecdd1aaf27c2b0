"""Layouts of time stamps in text feeds, found from the values themselves.

A feed writes its stamps in one layout, which nobody declares. One scan counts,
for every candidate, the values that it reads; the layout that reads most of them
is the feed's, and values in any other layout are null, as text that is no stamp.
The counts are plain sums, so they merge over partitions, files and days.

A feed that no candidate reads, or that two candidates read equally well (day and
month may be swapped in every value), is undecided and fails. A feed without any
stamp takes the first candidate.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Layout:
    """``pattern`` captures the parts of a whole value, ``iso`` puts them in the
    order that a cast reads.

    ``lengths`` (least, most) and ``marks`` (place, sign) follow from the pattern
    and spare most values most patterns; ``plain`` says that ``iso`` changes nothing.
    """

    name: str
    pattern: str
    iso: str
    lengths: tuple[int, int] | None = None
    marks: tuple[tuple[int, str], ...] = ()
    plain: bool = False

    def stamp(self, text: Column) -> Column:
        """Zone-free timestamp of text in this layout, else null. A day that the
        calendar lacks is null as well."""
        ordered = text if self.plain else F.regexp_replace(text, self.pattern, self.iso)
        fits = F.lit(True)
        if self.lengths:
            least, most = self.lengths
            fits = F.length(text).between(least, most + 2)  # $ also matches before a line's end
        for place, sign in self.marks:
            fits = fits & (F.substring(text, place, 1) == sign)
        return F.when(fits & text.rlike(self.pattern), ordered.try_cast("timestamp_ntz"))


# name, pattern, the places of year, month and day in it, and a sign that it has
_DATES = (
    ("yyyy-MM-dd", r"([0-9]{4})-([0-9]{2})-([0-9]{2})", "$1-$2-$3", (5, "-")),
    ("yyyy/MM/dd", r"([0-9]{4})/([0-9]{2})/([0-9]{2})", "$1-$2-$3", (5, "/")),
    ("dd/MM/yyyy", r"([0-9]{2})/([0-9]{2})/([0-9]{4})", "$3-$2-$1", (3, "/")),
    ("MM/dd/yyyy", r"([0-9]{2})/([0-9]{2})/([0-9]{4})", "$3-$1-$2", (3, "/")),
)
_SECONDS = "([0-9]{2}:[0-9]{2}:[0-9]{2}"
# name, pattern and place of the clock, lengths of the whole value, and a sign
_CLOCKS = (
    (" HH:mm:ss", f" {_SECONDS})", " $4", (19, 19), ((11, " "),)),
    ("THH:mm:ss", f"T{_SECONDS})Z?", " $4", (19, 20), ((11, "T"),)),
    (" HH:mm:ss.S", rf" {_SECONDS}\.[0-9]{{1,6}})", " $4", (21, 26), ((11, " "),)),
    ("THH:mm:ss.S", rf"T{_SECONDS}\.[0-9]{{1,6}})Z?", " $4", (21, 27), ((11, "T"),)),
    ("", "()", " 00:00:00", (10, 10), ()),
)
LAYOUTS = tuple(
    Layout(
        date + clock, f"^{days}{hours}$", order + rest, lengths, (*marks, mark),
        date == "yyyy-MM-dd" and clock.startswith(" "),
    )
    for date, days, order, mark in _DATES
    for clock, hours, rest, lengths, marks in _CLOCKS
)
DEFAULT = LAYOUTS[0]


class UndecidedLayout(ValueError):
    """The values of a feed do not tell its layout."""


def layout_counts(df: DataFrame, column: str, by: Sequence[str] = (), layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """(by, n_values, layout, place, n_read): per candidate, the values it
    reads. Nulls and blank texts are no values."""
    text = F.col(column)
    text = F.when(F.trim(text) != "", text)
    read = [layout.stamp(text) for layout in layouts]
    counts = df.groupBy(*by).agg(
        F.count(text).alias("n_values"), *[F.count(r).alias(f"_read_{k}") for k, r in enumerate(read)]
    )
    entries = [
        F.struct(F.lit(layout.name).alias("layout"), F.lit(k).alias("place"), F.col(f"_read_{k}").alias("n_read"))
        for k, layout in enumerate(layouts)
    ]
    return counts.select(*by, "n_values", F.inline(F.array(*entries)))


def feed_layouts(df: DataFrame, column: str, by: Sequence[str], layouts: Sequence[Layout] = LAYOUTS) -> dict[tuple, Layout]:
    """The layout of each feed; ``by`` names the feeds, of which there are few.
    One row per feed and candidate reaches the driver."""
    found: dict[tuple, list] = {}
    for row in layout_counts(df, column, by, layouts).collect():
        found.setdefault(tuple(row[b] for b in by), []).append(row)
    return {feed: _decided(feed, rows, layouts) for feed, rows in found.items()}


def feed_layout(df: DataFrame, column: str, layouts: Sequence[Layout] = LAYOUTS) -> Layout:
    """The layout of a column whose rows are one feed."""
    return feed_layouts(df, column, (), layouts)[()]


def _decided(feed: tuple, rows: list, layouts: Sequence[Layout]) -> Layout:
    values, most = rows[0]["n_values"], max(r["n_read"] for r in rows)
    if not values:
        return layouts[0]
    best = [r for r in rows if r["n_read"] == most]
    name = " ".join(map(str, feed)) or "feed"
    if not most:
        raise UndecidedLayout(f"{name}: no known layout reads any of {values} stamps")
    if len(best) > 1:
        raise UndecidedLayout(f"{name}: {' and '.join(r['layout'] for r in best)} each read {most} of {values} stamps")
    return layouts[best[0]["place"]]
