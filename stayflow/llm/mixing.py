"""Mixing sources to target weights with a low-discrepancy schedule.

Targets.  Every source has a weight; together they get ``share`` times all tokens.  A source gets at
most ``most`` times its own size; what it cannot take goes to the others by weight, again and again
until no source is above.

Blocks.  The documents of a source are put in a shuffled order (a hash) and the line of their tokens
is cut into blocks of equal size, to within one token.  A source takes its blocks in order, starting
again after the last one, until its target is reached; the last block is taken in part.

Schedule.  Slot ``i`` of the mixture stands at the golden-ratio point ``frac(i * phi)``; the point's
place in the cumulative shares of slots names the source, and the slot's rank among that source's
slots names the block.  Every stretch of the schedule thus holds the sources in their proportions.
Slots that a source lacks at the end (a matter of a few, by the discrepancy of the points) follow
after the last one; surplus slots are dropped.

Sums along a source are formed in two levels (hash ranges of the shuffle, then rows inside), so a
source that holds most rows is spread over many tasks.  Only the list of sources reaches the driver;
it is small by nature (one row per source).

Edge cases: a null text has no tokens; documents without tokens are never taken (``taken`` 0).  A null
source is a source of its own, last in order.  Rows that repeat are rows of their own.  An empty
table gives no rows; if no source has tokens all targets are zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayflow.sources.scratch import keep

WORD = r"[^\x20\x09-\x0D]+"
GOLDEN = 2654435769  # frac of the golden ratio times 2**32, rounded
_RANGE = 2**32


def n_words(text: Column | str) -> Column:
    """Number of words of a text; zero if null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: list[int], weights: list[float], share: float, most: float) -> list[float]:
    """Tokens that each source is to give."""
    left, out = share * sum(sizes), [0.0] * len(sizes)
    open_ = [k for k, size in enumerate(sizes) if size > 0]
    while open_:
        total = sum(weights[k] for k in open_)
        full = [k for k in open_ if left * weights[k] / total > most * sizes[k]] if total else open_
        if not full:
            for k in open_:
                out[k] = left * weights[k] / total
            break
        for k in full:
            out[k] = min(most * sizes[k], left)
            left -= out[k]
        open_ = [k for k in open_ if k not in full]
    return out


# A source's tokens are cut into blocks whose sizes differ by one at most: the first ``source_size % blocks`` are
# the larger ones.  Only quotients and remainders are formed, so sizes may be as large as a long.


def _block_begin(block: Column) -> Column:
    return block * F.expr("source_size div blocks") + F.least(block, F.expr("source_size % blocks"))


def _block_of(place: Column) -> Column:
    small, larger = F.expr("source_size div blocks"), F.expr("source_size % blocks")
    head = larger * (small + 1)
    return F.when(place < head, _quotient(place, small + 1)).otherwise(larger + _quotient(place - head, small))


def _quotient(a: Column, b: Column) -> Column:
    """Whole quotient of longs that are not negative, never through a double."""
    return F.call_function("div", a, b)


class Mix:
    """A mixture of ``docs``; ``size`` gives the tokens of a document.

    ``weights`` are dealt to the sources in order, over and over.
    """

    def __init__(
        self,
        docs: DataFrame,
        id_column: str = "doc_id",
        source_column: str = "source",
        text_column: str = "text",
        size: Column | None = None,
        weights: tuple[float, ...] = (5.0, 2.0, 1.0),
        share: float = 1.5,
        most: float = 2.0,
        block: int = 65_536,
        seed: int = 17,
        carry: bool = False,
    ):
        self.spark, self.block = docs.sparkSession, block
        row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
        size = n_words(text_column) if size is None else size
        columns = [
            F.col(id_column).alias("id"),
            F.col(source_column).alias("source"),
            size.alias("size"),
            F.xxhash64(id_column, text_column, F.lit(seed)).alias("place"),
        ]
        # sizes are read off the texts once; with ``carry`` the rows themselves are kept beside them
        columns = [*columns, F.monotonically_increasing_id().alias("uid")]
        self.whole = keep(docs.select(*columns, *([row] if carry else [])))
        self.rows = self.whole.drop("row")
        self.sources = self._sources(weights, share, most)
        self.docs = self._placed()

    def _sources(self, weights, share: float, most: float) -> list[dict]:
        """One entry per source, in order of code points, null last."""
        found = self.rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
        found = sorted(found, key=lambda r: (r["source"] is None, (r["source"] or "").encode("utf-8")))
        sizes = [r["size"] for r in found]
        goal = targets(sizes, [weights[k % len(weights)] for k in range(len(found))], share, most)
        out = []
        for k, r in enumerate(found):
            blocks = max(1, round(r["size"] / self.block))
            whole = int(goal[k])
            per = r["size"] / blocks
            slots = 0 if not whole else max(1, -int(-whole // per))
            out.append(
                {"source": r["source"], "number": k, "size": r["size"], "target": goal[k], "whole": whole}
                | {"blocks": blocks, "slots": slots, "ranges": max(1, r["n"] // 4096)}
            )
        return out

    def _table(self) -> DataFrame:
        return self.spark.createDataFrame(
            [tuple(s.values()) for s in self.sources],
            "source string, number int, source_size long, target double, whole long, blocks long, slots long, ranges long",
        )

    def _placed(self) -> DataFrame:
        """Every row with its stretch [``first``, ``first + size``) of its source's shuffled tokens."""
        named = self.rows.withColumnRenamed("source", "_source").join(
            F.broadcast(self._table()), F.col("_source").eqNullSafe(F.col("source"))
        )
        # 31 high bits of the hash, so that ranges follow its order
        part = F.shiftright(F.shiftright("place", 33) * F.col("ranges"), 31) + F.col("ranges")
        named = named.withColumn("part", part).drop("_source")
        sums = named.groupBy("number", "part").agg(F.sum("size").alias("inside"))
        before = Window.partitionBy("number").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        offsets = sums.select("number", "part", F.coalesce(F.sum("inside").over(before), F.lit(0)).alias("offset"))
        inside = (
            Window.partitionBy("number", "part")
            .orderBy("place", "id", "size")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        named = named.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        return named.join(offsets, ["number", "part"]).withColumn("first", F.col("offset") + F.col("inside"))

    def _holder(self, place: Column, edges: list[int]) -> Column:
        """The source in whose stretch of the cumulative slots a place lies."""
        held = [(lo, s["number"]) for s, lo in zip(self.sources, edges) if s["slots"]]
        begins = F.array(*[F.lit(lo).cast("long") for lo, _ in held]).cast("array<bigint>")
        numbers = F.array(*[F.lit(n) for _, n in held]).cast("array<int>")
        return F.get(numbers, F.size(F.filter(begins, lambda lo: lo <= place)) - 1)

    def schedule(self) -> DataFrame:
        """The mixture, slot by slot: ``slot``, source ``number``, ``rank`` and ``block`` of the source,
        and the stretch [``begin``, ``end``) of its shuffled tokens that the slot takes."""
        total = sum(s["slots"] for s in self.sources)
        edge, edges = 0, []
        for s in self.sources:
            edges.append(edge)
            edge += s["slots"]
        stretch = 65_536
        slots = self.spark.range(total).select(
            F.col("id").alias("slot"),
            (F.col("id") / stretch).cast("long").alias("stretch"),
            # the golden-ratio point, in units of one slot; whole numbers keep it exact
            F.floor(
                F.pmod(F.pmod("id", F.lit(_RANGE // 2)) * F.lit(GOLDEN), F.lit(_RANGE)).cast("double")
                * F.lit(float(total)) / float(_RANGE)
            ).alias("point"),
        )
        named = slots.withColumn("number", self._holder(F.col("point"), edges))
        counts = named.groupBy("number", "stretch").agg(F.count("*").alias("n"))
        before = Window.partitionBy("number").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.select("number", "stretch", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
        within = Window.partitionBy("number", "stretch").orderBy("slot")
        ranked = named.withColumn("at", F.row_number().over(within) - 1).join(offsets, ["number", "stretch"])
        ranked = ranked.select("number", (F.col("at") + F.col("offset")).alias("rank"), "slot")
        table = self.spark.createDataFrame(
            [(s["number"], s["size"], s["whole"], s["blocks"], e) for s, e in zip(self.sources, edges)],
            "number int, source_size long, whole long, blocks long, edge long",
        )
        # what each source needs: its slots 0, 1, 2, ...
        wanted = self.spark.range(total).withColumn("number", self._holder(F.col("id"), edges))
        wanted = wanted.join(F.broadcast(table), "number").withColumn("rank", F.col("id") - F.col("edge"))
        all_ = wanted.join(ranked, ["number", "rank"], "left")
        block = F.col("rank") % F.col("blocks")
        begin, end = _block_begin(block), _block_begin(block + 1)
        round_ = (F.col("rank") / F.col("blocks")).cast("long")
        left = F.col("whole") - round_ * F.col("source_size")  # of the target, for this round
        return all_.select(
            F.coalesce("slot", F.lit(total) + F.col("rank") * F.lit(len(self.sources)) + F.col("number")).alias("slot"),
            "number",
            "rank",
            block.alias("block"),
            begin.alias("begin"),
            F.least(end, left).alias("end"),
        ).filter("end > begin")

    def pieces(self) -> DataFrame:
        """The mixture itself: which words of which document each slot takes.

        Columns: the placed row's, ``slot``, and the words [``from_word``, ``to_word``) of the document.
        """
        # blocks that the stretch of the row meets
        met_blocks = F.sequence(_block_of(F.col("first")), _block_of(F.col("first") + F.col("size") - 1))
        own = self.docs.filter("size > 0").withColumn("block", F.explode(met_blocks))
        met = own.join(self.schedule(), ["number", "block"])
        met = met.withColumn("from_word", F.greatest("begin", "first") - F.col("first"))
        met = met.withColumn("to_word", F.least(F.col("end"), F.col("first") + F.col("size")) - F.col("first"))
        return met.filter("to_word > from_word")

    def taken(self) -> DataFrame:
        """Every document with the number of its words in the mixture, repeats counted.

        Columns ``id``, ``size``, ``source_size``, ``target``, ``taken``, ``times`` (how often its first
        word is taken).
        """
        words = F.sum(F.col("to_word") - F.col("from_word"))
        times = F.sum((F.col("from_word") == 0).cast("long"))
        got = self.pieces().groupBy("number", "first").agg(words.alias("taken"), times.alias("times"))
        full = self.docs.filter("size > 0").join(got, ["number", "first"], "left").select(
            "id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"),
            F.coalesce("times", F.lit(0)).alias("times"),
        )
        none = self.docs.filter("size = 0").select(
            "id", "size", "source_size", "target", F.lit(0).cast("long").alias("taken"), F.lit(0).cast("long").alias("times")
        )
        return full.union(none)

    def mixed(self) -> DataFrame:
        """Whole documents in the mixture: each row as often as its first word is taken, with its ``slot``.

        Needs ``carry``; the column ``row`` holds the row.
        """
        slots = self.pieces().filter("from_word = 0").select("uid", "slot")
        return self.whole.select("uid", "row").join(slots, "uid").select("row", "slot")
