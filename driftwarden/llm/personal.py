"""Personal data: base patterns as seeds, and contexts learnt from them that find further identifiers."""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwarden.llm.common import columns_of, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KINDS = ("email", "ip", "card", "phone")
#: Characters of an address before its @, and what follows it.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_HINT = re.compile(r"[0-9@]")
#: Numbers that may be parts of one identifier, what may stand between them, and most digits of an identifier.
_NUMBER = re.compile(r"[0-9][0-9().-]*")
_GAP = re.compile(r"\)? ?-? ?\(?")
DIGITS = 19
#: Characters other than letters, digits and underscores over which a context reaches from word to word.
REACH = 60
#: A longer word stands in a pattern by its digest.
_SPELT = 64
#: Least confidence of a pattern and of an instance, weight of an instance of unknown kind.
SURE_PATTERN, SURE_INSTANCE, UNKNOWN = 0.8, 0.9, 0.25


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each @ outwards so that long words cost one pass."""
    free, at = 0, text.find("@")
    while at >= 0:
        before = text[free:at]
        start = free + len(before.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """Four numbers at a time from each run of numbers joined by dots."""
    for run in _DOTTED.finditer(text):
        parts = run.group().split(".")
        start = run.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield start, end
            start = end + 1


def _luhn(digits: str) -> bool:
    doubled = (2 * int(d) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 8 <= sum(map(m.group().count, "0123456789")) <= 15:
            yield m.span()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base matches, by kind and start; code points, end exclusive."""
    finders = (_emails, _ips, _cards, _phones)
    return [(k, a, b) for k, find in enumerate(finders) for a, b in find(text)]


def _tokens(text: str, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Runs without white space that hold a digit or an @ and touch no base match, without the punctuation around them."""
    done, i = 0, 0
    taken = sorted(taken)
    for hint in _HINT.finditer(text):
        if hint.start() < done:
            continue
        start = hint.start()
        while start > done and not text[start - 1].isspace():
            start -= 1
        end = hint.end()
        while end < len(text) and not text[end].isspace():
            end += 1
        done = end
        while start < end and not text[start].isalnum():
            start += 1
        while end > start and not text[end - 1].isalnum():
            end -= 1
        while i < len(taken) and taken[i][1] <= start:
            i += 1
        if start < end and not (i < len(taken) and taken[i][0] < end):
            yield start, end


def _candidates(text: str, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Identifier-like spans: tokens, and numbers written in groups as one span unless they hold more than DIGITS digits."""
    chain: list[tuple[int, int]] = []

    def closed() -> list[tuple[int, int]]:
        if len(chain) > 1 and sum(c.isdigit() for c in text[chain[0][0] : chain[-1][1]]) <= DIGITS:
            return [(chain[0][0], chain[-1][1])]
        return chain

    for start, end in _tokens(text, taken):
        number = _NUMBER.fullmatch(text, start, end) is not None
        if chain and not (number and start > chain[-1][1] and _GAP.fullmatch(text, chain[-1][1], start)):
            yield from closed()
            chain = []
        if number:
            chain.append((start, end))
        else:
            yield start, end
    yield from closed()


def _word_before(text: str, end: int) -> tuple[int, int]:
    """The span of the last word that ends within REACH characters before ``end``; empty where there is none."""
    low = max(0, end - REACH)
    while end > low and not (text[end - 1].isalnum() or text[end - 1] == "_"):
        end -= 1
    start = end
    while start > 0 and (text[start - 1].isalnum() or text[start - 1] == "_"):
        start -= 1
    return start, end


def _word_after(text: str, start: int) -> tuple[int, int]:
    high = min(len(text), start + REACH)
    while start < high and not (text[start].isalnum() or text[start] == "_"):
        start += 1
    end = start
    while end < len(text) and (text[end].isalnum() or text[end] == "_"):
        end += 1
    return start, end


def _spelt(word: str) -> str:
    word = word.lower()
    return word if len(word) <= _SPELT else hashlib.md5(word.encode("utf-8", "surrogatepass")).hexdigest()


def contexts(text: str, start: int, end: int) -> list[str]:
    """The patterns of one occurrence: one and two words before it, with and without the word after it."""
    near = _word_before(text, start)
    far = _word_before(text, near[0])
    after = _word_after(text, end)
    left, before, right = (_spelt(text[a:b]) for a, b in (near, far, after))
    out = [f"{left} _"] if left else []
    if left and before:
        out.append(f"{before} {left} _")
    if left and right:
        out.append(f"{left} _ {right}")
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def _finder():
    """A column function text -> base spans, their digest, and all occurrences with their contexts."""

    @F.pandas_udf(
        "struct<base:array<struct<kind:int,start:int,end:int>>,base_sha256:string,"
        "seen:array<struct<kind:int,start:int,end:int,value:string,patterns:array<string>>>>"
    )
    def find(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            text = text or ""
            base = base_spans(text) if _HINT.search(text) else []
            seen = [(k, a, b) for k, a, b in base]
            if _HINT.search(text):
                seen += [(-1, a, b) for a, b in _candidates(text, [(a, b) for _, a, b in base])]
            rows.append(
                (
                    [{"kind": k, "start": a, "end": b} for k, a, b in base],
                    hashlib.sha256(joined(base).encode()).hexdigest(),
                    [
                        {
                            "kind": k,
                            "start": a,
                            "end": b,
                            "value": hashlib.md5(text[a:b].lower().encode("utf-8", "surrogatepass")).hexdigest(),
                            "patterns": contexts(text, a, b),
                        }
                        for k, a, b in seen
                    ],
                )
            )
        return pd.DataFrame(rows, columns=["base", "base_sha256", "seen"])

    return find


def learnt_patterns(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Score the graph of patterns and instances until a round finds no further instance.

    ``edges`` (pattern, value, kind; -1 where unknown), each once. A pattern
    trusts a kind by the instances of that kind among those it holds, others
    against it and unknown ones at UNKNOWN, with two doubts added; so it takes
    eight seeds at least. An unknown instance is of a kind unless all its
    trusted patterns of that kind err; of several kinds the likeliest counts,
    the first one listed among equals. What a round finds is a seed of the next
    and stays found, a trusted pattern stays trusted: so every round but the last
    adds instances, and the rounds end. Returns (pattern, kind, trust) trusted
    and (value, kind, belief) found.
    """
    unknown = written(edges.where("kind < 0").select("pattern", "value"), "pii-unknown")
    held = written(
        edges.where("kind >= 0").groupBy("pattern", "kind").agg(F.count(F.lit(1)).cast("double").alias("own")), "pii-held"
    )
    spark = edges.sparkSession
    value = edges.schema["value"].dataType.simpleString()
    found = spark.createDataFrame([], f"value {value}, kind int, belief double")
    trusted = spark.createDataFrame([], "pattern string, kind int, trust double")
    while True:
        more = unknown.join(found, "value").groupBy("pattern", "kind").agg(F.sum("belief").alias("own"))
        own = held.unionByName(more).groupBy("pattern", "kind").agg(F.sum("own").alias("own"))
        open_ = unknown.join(found.select("value"), "value", "left_anti")
        total = own.groupBy("pattern").agg(F.sum("own").alias("all"))
        doubts = open_.groupBy("pattern").agg(F.count(F.lit(1)).alias("unknown"))
        trust = F.col("own") / (F.col("all") + F.lit(UNKNOWN) * F.coalesce("unknown", F.lit(0)) + 2)
        now = (
            own.join(total, "pattern")
            .join(doubts, "pattern", "left")
            .select("pattern", "kind", trust.alias("trust"))
            .where(F.col("trust") >= SURE_PATTERN)
        )
        trusted = written(
            trusted.unionByName(now).groupBy("pattern", "kind").agg(F.max("trust").alias("trust")), "pii-patterns"
        )
        belief = 1 - F.exp(F.sum(F.log1p(-F.least("trust", F.lit(0.999)))))
        fresh = open_.join(trusted, "pattern").groupBy("value", "kind").agg(belief.alias("belief"))
        fresh = fresh.groupBy("value").agg(F.max_by(F.struct("kind", "belief"), F.struct("belief", -F.col("kind"))).alias("b"))
        fresh = written(fresh.select("value", "b.*").where(F.col("belief") >= SURE_INSTANCE), "pii-instances")
        if fresh.isEmpty():
            return trusted, found
        found = written(found.unionByName(fresh), "pii-found")


def _of_kind(kind: int) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")


def personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Personal data of every whole text.

    Columns: doc_id, n_email, n_ip, n_card, n_phone (base matches),
    base_sha256, spans (base and learnt ones, "kind:start:end" by kind and
    start), n_learnt. Base matches are the seeds: the words around them induce
    patterns, the graph of patterns and instances is scored in rounds until
    nothing new is found, and identifier-like spans whose patterns are trusted
    are added under the kind of those patterns. Such a span holds a digit or an @,
    as all four kinds do: a run without white space, or numbers joined by the
    separators of the base patterns. It touches no base match; base matches always stay. A
    NULL or empty text has no spans; repeated rows count as one seed per value
    and get equal results; an empty table gives no rows. Texts are read once;
    only occurrences and their contexts are shuffled, a very common context or
    value being one row per distinct pair.
    """
    rows = columns_of(docs, doc_id=key, text=text).select(
        "doc_id", F.monotonically_increasing_id().alias("row"), _finder()(F.col("text")).alias("f")
    )
    table = written(rows.select("doc_id", "row", "f.*"), "pii-base")
    seen = table.select("row", F.explode("seen").alias("o")).select("row", "o.*")
    edges = seen.select(F.explode("patterns").alias("pattern"), "value", "kind").distinct()
    trusted, found = learnt_patterns(written(edges, "pii-edges"))
    occurrences = seen.where("kind < 0").select("row", "start", "end", "value", F.explode("patterns").alias("pattern"))
    kind = F.max_by("kind", F.struct("trust", (-F.col("kind")).alias("first")))
    learnt = (
        occurrences.join(trusted, "pattern")
        .join(found.drop("belief"), ["value", "kind"])
        .groupBy("row", "start", "end")
        .agg(kind.alias("kind"))
        .groupBy("row")
        .agg(F.collect_list(F.struct("kind", "start", "end")).alias("learnt"))
    )
    out = table.join(learnt, "row", "left")
    none = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    spans = F.array_sort(F.concat("base", F.coalesce("learnt", none)))
    name = F.array(*[F.lit(k) for k in KINDS])
    text_of = F.transform(spans, lambda s: F.concat_ws(":", F.element_at(name, s["kind"] + 1), s["start"], s["end"]))
    counts = [_of_kind(i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return out.select(
        "doc_id",
        *counts,
        "base_sha256",
        F.array_join(text_of, ",").alias("spans"),
        F.size(F.coalesce("learnt", none)).cast("bigint").alias("n_learnt"),
    )
