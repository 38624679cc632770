"""Line deduplication by a segment-partition edit join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwarden.llm.common import columns_of, components, written

#: (edits, characters): how many edits two lines may be apart when the shorter of them has so many characters or more, up to
#: the next entry; still shorter lines count only as equals. Two edits on a word of three letters link almost any two.
BANDS = ((1, 9), (2, 24))


def _places(docs: DataFrame) -> DataFrame:
    """One row per line that is not blank (``full``), and the first line of every text even if it is.

    Each place carries two hashes that name the text of its line.
    """
    rows = docs.select("doc_id", "row", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("pos", "line"))
    full = F.trim("line") != ""
    return rows.where(full | (F.col("pos") == 0)).select(
        "doc_id", "row", "pos", full.alias("full"), F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2")
    )


def _texts(docs: DataFrame) -> DataFrame:
    """The lines that are not blank, with the same two hashes."""
    rows = docs.select(F.explode(F.split("text", "\n")).alias("line")).where(F.trim("line") != "")
    return rows.select("line", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2"))


def _cuts(edits: int) -> list[tuple[int, int, int]]:
    """(gap, segment, shift) of every key of a line, in order."""
    return [
        (gap, i, shift)
        for gap in range(edits + 1)
        for i in range(edits + 1)
        for shift in range(max(-i, gap - (edits - i)), min(i, gap + (edits - i)) + 1)
    ]


def segment_keys(line: Column, edits: int) -> Column:
    """The keys under which a line is indexed and probed, in the order of ``_cuts``.

    A line of n characters is cut into edits + 1 segments as even as can be. A
    line at most ``edits`` edits away and ``gap`` characters longer holds one
    of them unchanged, shifted by no more than the edits before and after it
    allow. The unshifted segments of a line are its index entries and probe its
    own length as well; the others only probe.
    """
    parts = edits + 1
    keys = []
    for gap, i, shift in _cuts(edits):
        size = F.length(line) - gap
        base, wider = F.floor(size / parts).cast("int"), size % parts
        start = F.lit(1) + base * i + F.greatest(F.lit(0), wider - (parts - i))
        length = base + F.when(wider >= parts - i, 1).otherwise(0)
        keys.append(F.xxhash64(F.substring(line, start + shift, length), F.lit(i), size))
    return F.array(*keys)


def _ranges(bands: Sequence[tuple[int, int]]) -> list[tuple[int, list[int]]]:
    """(least length, edits of the bands whose pairs such a line can belong to), from one length to the next."""
    ends = [next_least + edits for (edits, _), (_, next_least) in zip(bands, bands[1:], strict=False)]
    spans = [(edits, least, end) for (edits, least), end in zip(bands, [*ends, None], strict=True)]
    cuts = sorted({least for _, least in bands} | set(ends))
    return [(n, [e for e, least, end in spans if least <= n and (end is None or n < end)]) for n in cuts]


def _banded_keys(bands: Sequence[tuple[int, int]]) -> tuple[Column, Column]:
    """Keys of a line in every band it can belong to, and which of the ranges of lengths it is in.

    Plain arrays, one per range: these stay in generated code, where a lambda
    over the keys does not.
    """
    size = F.length("line")
    keys = number = None
    for at, (least, edits) in reversed(list(enumerate(_ranges(bands)))):
        held = F.concat(*[segment_keys(F.col("line"), e) for e in edits]) if len(edits) > 1 else segment_keys(F.col("line"), edits[0])
        keys = F.when(size >= least, held) if keys is None else keys.when(size >= least, held)
        number = F.when(size >= least, F.lit(at)) if number is None else number.when(size >= least, F.lit(at))
    return keys, number


def _is_entry(bands: Sequence[tuple[int, int]]) -> Column:
    """Whether the key at a place of its range's array is an index entry."""
    hit = F.lit(False)
    for number, (_, edits) in enumerate(_ranges(bands)):
        cuts = [c for e in edits for c in _cuts(e)]
        entries = [at for at, (gap, _, shift) in enumerate(cuts) if gap == shift == 0]
        hit = hit | ((F.col("number") == number) & F.col("at").isin(entries))
    return hit


def _close(line: str, other: str, bands: Sequence[tuple[int, int]]) -> Column:
    """Whether two lines are as few edits apart as the length of the shorter one allows."""
    shorter = F.least(F.length(line), F.length(other))
    apart = F.when(shorter < bands[0][1], F.lit(-1))
    for at, (edits, _) in enumerate(bands):
        last = at + 1 == len(bands)
        apart = apart.when(F.lit(True) if last else shorter < bands[at + 1][1], F.levenshtein(line, other, edits))
    return apart >= 0


def line_links(lines: DataFrame, bands: Sequence[tuple[int, int]] = BANDS) -> DataFrame:
    """(h1, h2, g1, g2): pairs of different lines no more edits apart than ``bands`` allow, each once.

    ``lines`` (line, h1, h2). Equal lines are dropped to one before they are
    cut. Keys are gathered as narrow rows; only those that meet an index entry
    of another line go on, and only then are the texts of their lines fetched.
    The distance is checked inside the join, so pairs that merely share a
    segment never leave it, and a key of very many lines is split by Spark.
    """
    if any(least <= edits for edits, least in bands):
        raise ValueError("a line needs a character for each of its edits + 1 segments")
    long = lines.where(F.length("line") >= bands[0][1])
    keys, number = _banded_keys(bands)
    cut = long.select("h1", "h2", number.alias("number"), keys.alias("keys")).dropDuplicates(["h1", "h2"])
    keyed = cut.select("h1", "number", F.posexplode("keys").alias("at", "key"))
    keyed = keyed.select("h1", "key", _is_entry(bands).alias("indexed"))
    same = Window.partitionBy("key")
    meeting = (
        keyed.withColumn("a", F.min("h1").over(same))
        .withColumn("b", F.max("h1").over(same))
        .withColumn("entries", F.max("indexed").over(same))
        .where((F.col("a") != F.col("b")) & F.col("entries"))
        .select("key", "indexed", "h1")
    )
    active = written(meeting, "line-keys")
    texts = written(
        long.join(active.select("h1").distinct(), "h1").select("h1", "h2", "line").dropDuplicates(["h1", "h2"]),
        "line-texts",
    )
    held = active.join(texts, "h1")
    left = held.where("indexed").select("key", "h1", "h2", "line")
    right = held.select(
        "key", F.col("h1").alias("g1"), F.col("h2").alias("g2"), F.col("line").alias("other"), F.col("indexed").alias("own")
    )
    # Two index entries of one key meet twice; the pair is taken up from its smaller side.
    once = ~F.col("own") | (F.col("h1") < F.col("g1"))
    different = (F.col("h1") != F.col("g1")) & once
    pairs = left.join(right, (left["key"] == right["key"]) & different & _close("line", "other", bands))
    up = F.col("h1") < F.col("g1")
    ends = [F.when(up, F.col(a)).otherwise(F.col(b)).alias(a) for a, b in (("h1", "g1"), ("h2", "g2"))]
    other = [F.when(up, F.col(b)).otherwise(F.col(a)).alias(b) for a, b in (("h1", "g1"), ("h2", "g2"))]
    return pairs.select(*ends, *other).distinct()


def line_classes(occurrences: DataFrame, links: DataFrame) -> DataFrame:
    """(h1, h2, first, near): for lines that occur again, the first place of their class.

    A class is what links reach. ``near`` tells that the first place holds
    another line.
    """
    place = F.struct("doc_id", "row", "pos")
    classes = written(
        occurrences.groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
        .withColumn("node", F.monotonically_increasing_id()),
        "line-classes",
    )
    one = links.join(classes.select("h1", "h2", F.col("node").alias("u")), ["h1", "h2"])
    other = classes.select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), F.col("node").alias("v"))
    joined = components(one.join(other, ["g1", "g2"]).select("u", "v"), "line-components")
    placed = classes.join(joined, "node")
    # A minimum per class joined back: a very large class is dealt again by Spark, a window would sort it in one task.
    near = (
        placed.join(placed.groupBy("component").agg(F.min("first").alias("least")), "component")
        .select("h1", "h2", F.col("least").alias("first"), (F.col("least") != F.col("first")).alias("near"))
    )
    again = classes.where("n > 1").join(joined.select("node"), "node", "left_anti")
    return near.unionByName(again.select("h1", "h2", "first", F.lit(False).alias("near")))


def repeated_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", bands: Sequence[tuple[int, int]] = BANDS
) -> DataFrame:
    """Which lines of each document repeat an earlier one.

    Columns: doc_id, n_lines (not blank), n_exact and n_near (lines that repeat
    an equal or a nearly equal line), removed (their places, counted from 0).
    Of every class of lines the first place stays, in the order of doc_id, row
    and place. How many edits apart two lines may be follows from the length of
    the shorter one (``bands``); shorter lines count only as equals. Whole lines
    are compared, whatever their length. NULL and empty texts have no lines;
    rows that repeat an id are documents of their own, in no stated order among
    themselves; an empty table gives no rows.

    Rows are numbered in the one pass that writes their places; everything else
    that names a row reads that table.
    """
    rows = columns_of(docs, doc_id=key, text=text)
    places = written(_places(rows.withColumn("row", F.monotonically_increasing_id())), "line-places")
    occurrences = places.where("full").select("doc_id", "row", "pos", "h1", "h2")
    again = line_classes(occurrences, line_links(_texts(rows), bands))
    here = F.struct("doc_id", "row", "pos")
    gone = (
        occurrences.join(again, ["h1", "h2"])
        .where(~here.eqNullSafe(F.col("first")))
        .groupBy("row")
        .agg(
            F.count_if(~F.col("near")).alias("n_exact"),
            F.count_if(F.col("near")).alias("n_near"),
            F.array_sort(F.collect_list("pos")).alias("removed"),
        )
    )
    base = places.groupBy("row").agg(F.any_value("doc_id").alias("doc_id"), F.count_if("full").alias("n_lines"))
    zero = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_lines", "n_exact", "n_near")]
    none = F.array().cast("array<int>")
    return (
        base.join(gone, "row", "left")
        .select("doc_id", *zero, F.coalesce("removed", none).alias("removed"))
    )


def without_repeats(docs: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` (ids unique) with the lines listed in ``found`` taken out of their texts."""
    listed = found.where(F.size("removed") > 0).select(F.col("doc_id").alias("__id"), F.col("removed").alias("__gone"))
    lines = F.split(F.col(f"`{text}`"), "\n")
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(F.col("__gone"), i)), "\n")
    joined = docs.join(listed, F.col(f"`{key}`") == F.col("__id"), "left")
    value = F.when(F.col("__gone").isNull(), F.col(f"`{text}`")).otherwise(kept)
    return joined.select(*[(value if c == text else F.col(f"`{c}`")).alias(c) for c in docs.columns])
