"""Quoted delimited text, read in ranges.

A quoted value may hold line ends, so a line alone doesn't tell whether it is a
record, and a reader that must know gives a whole file to one task.  Here files
are read as lines, many ranges a file.  A line that by itself has all values is a
record, wherever it stands; only lines that haven't, *loose* ones, are looked at
together:

1. Each range's lines are counted, which numbers the lines of a file.
2. Quotes toggle between inside and outside of a value.  Loose lines with an odd
   number of quotes are numbered through the file (counts by range, summed up over
   ranges, then within each); number ``i`` and ``i + 1`` with the loose lines
   between them are run ``i``.
3. A run is a record if its lines follow each other without a record in between,
   and together have all values, with every quote in its place.
4. Runs that follow each other share a line.  The first of such a chain is taken,
   then every second one.
5. Loose lines that no taken run has are rejected, each for itself.  So a stray
   quote costs its own line, as the records after it stand by themselves.

Nothing is sorted or summed wider than a range or a chunk of runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spendloom.store import landed_once

#: Runs of more characters are taken for a stray quote.
LONGEST = 1 << 24
#: Numbers of a chunk.
CHUNK = 1 << 16


class Quoted:
    """Records of files whose lines end in any line end; the first line of each is its header."""

    def __init__(self, spark: SparkSession, path: str, headers: tuple[str, ...], longest: int = LONGEST):
        self.headers, self.longest = headers, longest
        at = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range")
        text = spark.read.text(path).select("value", *at, F.monotonically_increasing_id().alias("id"))
        self.lines = text.withColumn("whole", self._has_all(F.col("value")))
        ranges = self.lines.groupBy("file", "range").agg(
            F.count("*").alias("n"),
            F.min("id").alias("first_id"),
            F.min_by("value", "id").alias("first"),
            F.count_if(~F.col("whole") & (F.col("value") != "")).alias("loose"),
        )
        self.ranges = landed_once(ranges, "ranges")

    def _has_all(self, line: Column) -> Column:
        """Whether a text has as many values as there are headers, each quote at a value's ends, doubled, or inside an unquoted value."""
        value = r'(?:"[^"]*+(?:""[^"]*+)*+"|[^",\n][^,\n]*+|)'
        pattern = f"^{value}(?:,{value}){{{len(self.headers) - 1}}}$" if len(self.headers) > 1 else f"^{value}$"
        plain = F.length(line) - F.length(F.replace(line, F.lit(","), F.lit(""))) == len(self.headers) - 1
        return F.when(F.contains(line, F.lit('"')), line.rlike(pattern)).otherwise(plain)

    def values(self, text: Column) -> Column:
        """Values of a record, as texts."""
        schema = ", ".join(f"`{h}` string" for h in self.headers)
        return F.from_csv(text, schema, {"escape": '"', "maxCharsPerColumn": "-1"})

    def check_headers(self) -> int:
        """Fails for a file whose first line is not the header; returns the number of loose lines."""
        given = F.array(*[self.values(F.col("first"))[h] for h in self.headers])
        same = F.coalesce(given == F.array(*map(F.lit, self.headers)), F.lit(False))
        wrong = F.min(F.when((F.col("range") == 0) & ~same, F.col("file")))
        found, loose = self.ranges.agg(wrong, F.sum("loose")).first()
        if found is not None:
            raise ValueError(f"the header of {found} is not {', '.join(self.headers)}")
        return loose or 0

    def plain(self) -> DataFrame:
        """``text`` of the records that are lines."""
        first = self.headers[0]
        kept = self.lines.filter("whole").filter(~self._is_header(first))
        return kept.select(F.col("value").alias("text"))

    def _is_header(self, first: str) -> Column:
        """Files' first lines; a quick look tells the others."""
        near = F.substring(F.ltrim(F.replace(F.col("value"), F.lit('"'), F.lit(""))), 1, len(first)) == first
        given = F.array(*[self.values(F.col("value"))[h] for h in self.headers])
        return F.when(near, F.coalesce(given == F.array(*map(F.lit, self.headers)), F.lit(False))).otherwise(F.lit(False))

    def numbered(self) -> DataFrame:
        """Loose lines: ``file, range, line`` (its number in the file), ``value, odd``, ``odds`` and ``nth`` (running counts)."""
        before = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
        starts = self.ranges.select("file", "range", "first_id", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
        quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
        loose = (
            self.lines.filter("NOT whole")
            .join(starts, ["file", "range"])
            .select("file", "range", (F.col("start") + F.col("id") - F.col("first_id")).alias("line"), "value", (quotes % 2).alias("odd"))
        )
        return running(loose, "range", "line", odds=F.col("odd"), nth=F.lit(1))

    def runs(self, loose: DataFrame) -> DataFrame:
        """``file, run, text`` of runs that are records; ``low`` and ``high`` are their lines."""
        # Loose lines that follow each other have the same difference of line and count.
        streak = (F.col("line") - F.col("nth")).alias("streak")
        length = F.length("value").alias("length")
        opens = loose.filter("odds > 0").select("file", F.col("odds").alias("run"), "line", streak, length, "value", (F.col("odd") == 1).alias("opens"), F.lit(False).alias("closes"))
        closes = loose.filter("odd = 1 AND odds > 1").select("file", (F.col("odds") - 1).alias("run"), "line", streak, length, "value", F.lit(False), F.lit(True))
        members = opens.union(closes)
        ends = members.groupBy("file", "run").agg(
            F.min(F.when(F.col("opens"), F.struct("streak", "line"))).alias("low"),
            F.min(F.when(F.col("closes"), F.struct("streak", "line"))).alias("high"),
            F.sum("length").alias("length"),
        )
        near = ends.filter(F.col("low.streak") == F.col("high.streak")).filter(F.col("length") <= self.longest)
        near = near.select("file", "run", F.col("low.line").alias("low"), F.col("high.line").alias("high"))
        texts = members.join(near, ["file", "run"]).groupBy("file", "run", "low", "high")
        ordered = F.sort_array(F.collect_list(F.struct("line", "value")))  # one record's lines
        joined = texts.agg(F.array_join(F.transform(ordered, lambda x: x["value"]), "\n").alias("text"))
        return joined.filter(self._has_all(F.col("text")))

    def taken(self, runs: DataFrame) -> DataFrame:
        """The first of runs that follow each other, and every second one after it."""
        chunked = runs.withColumn("chunk", F.floor(F.col("run") / CHUNK))
        chained = running(chunked, "chunk", "run", nth=F.lit(1)).withColumn("chain", F.col("run") - F.col("nth"))
        heads = chained.groupBy("file", "chain").agg(F.min("run").alias("head"))
        placed = chained.join(heads, ["file", "chain"])
        return placed.filter((F.col("run") - F.col("head")) % 2 == 0).select("file", "run", "low", "high", "text")

    def rejected(self, loose: DataFrame, taken: DataFrame) -> DataFrame:
        """``text`` of the loose lines that no taken run has."""
        used = taken.select("file", F.explode(F.sequence("low", "high")).alias("line"))
        return loose.filter("value != ''").join(used, ["file", "line"], "left_anti").select(F.col("value").alias("text"))


def running(rows: DataFrame, part: str, order: str, **sums: Column) -> DataFrame:
    """``rows`` with sums over all rows of the file up to each, by ``order``; ``part`` cuts a file into consecutive parts.

    Parts are summed first and their sums summed up, so that no window holds more than a part, or a row for each part.
    """
    marked = rows.withColumns({f"_{name}": value for name, value in sums.items()})
    totals = marked.groupBy("file", part).agg(*[F.sum(f"_{name}").alias(f"_{name}") for name in sums])
    before = Window.partitionBy("file").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("file", part, *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}_before") for n in sums])
    within = Window.partitionBy("file", part).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = marked.join(offsets, ["file", part])
    found = found.withColumns({name: F.col(f"_{name}_before") + F.sum(f"_{name}").over(within) for name in sums})
    return found.drop(*[f"_{name}" for name in sums], *[f"_{name}_before" for name in sums])
