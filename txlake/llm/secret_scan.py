"""Secrets by regular expressions over a trigram inverted index, in DataFrame functions only.

From each rule's expression a Boolean trigram query is derived: an AND over its mandatory stretches, each an OR over
the stretch's spellings, each an AND over the spelling's trigrams. One scan posts every document under the trigrams
that any rule asks for (the vocabulary is bounded by the rules), the postings of a document meet by its doc_id, the
queries are evaluated on them, and only candidates are verified with the expression itself. A rule without a
mandatory trigram scans every text in full.

Positions count code points, the end is exclusive. Matches of one kind are leftmost and do not overlap; a match that
is too short is dropped after it has been consumed. Defined cases: a null or empty text has no spans; a null doc_id is
scanned like any other; rows that repeat a doc_id are scanned each by itself; an empty table gives an empty result;
extra columns are ignored by ``spans`` and kept by ``redacted``.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass
from re import _constants as op
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    #: The group whose length decides, and its least length.
    group: int = 0
    least: int = 1


BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),  # the runs of 24 or more: shorter ones need not be matched to be dropped
)
ADDED = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("payment", r"[rs]k_live_[A-Za-z0-9]{16,}"),
)
MOST_SPELLINGS = 64
SPAN = "struct<start:int,order:int,end:int,kind:string,size:int>"
#: Code points of the blocks that a text is cut into for replacements, and the items that a fold takes at a time.
BLOCK, CHUNK = 4096, 128


def spellings(parsed, fold: bool) -> tuple[list[frozenset[str]], frozenset[str] | None]:
    """(stretches that every match contains, all strings of the expression or None if they are too many)."""
    stretches: list[frozenset[str]] = []
    run: frozenset[str] | None = frozenset([""])

    def close() -> None:
        nonlocal run
        if run is not None and run != frozenset([""]):
            stretches.append(run)
        run = frozenset([""])

    whole: frozenset[str] | None = frozenset([""])
    for kind, value in parsed:
        inner: list[frozenset[str]] = []
        exact: frozenset[str] | None = None
        if kind is op.LITERAL:
            exact = frozenset([chr(value).lower()])
        elif kind is op.IN and all(k is op.LITERAL for k, _ in value):
            exact = frozenset(chr(v).lower() for _, v in value)
        elif kind is op.SUBPATTERN:
            inner, exact = spellings(value[3], fold)
        elif kind is op.BRANCH:
            found = [spellings(b, fold)[1] for b in value[1]]
            exact = frozenset().union(*found) if all(f is not None for f in found) else None
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT):
            low, high, what = value
            inner, exact = spellings(what, fold) if low else ([], spellings(what, fold)[1])
            if exact is not None and high <= 4:
                exact = frozenset("".join(p) for n in range(low, high + 1) for p in itertools.product(exact, repeat=n)) if len(exact) ** high <= MOST_SPELLINGS else None
            elif low == 1 and exact is not None:
                inner, exact = [exact], None
            else:
                exact = None
        joined = None if exact is None or run is None else frozenset(a + b for a in run for b in exact)
        if joined is not None and len(joined) <= MOST_SPELLINGS:
            run = joined
        else:
            close()
            stretches += inner
            if exact is not None:
                run = exact
        whole = None if whole is None or exact is None else frozenset(a + b for a in whole for b in exact)
        if whole is not None and len(whole) > MOST_SPELLINGS:
            whole = None
    close()
    return stretches, whole


def trigram_query(pattern: str) -> list[list[list[str]]]:
    """AND of OR of AND of lower-case trigrams that every match must contain; empty if nothing is mandatory."""
    query = []
    for stretch in spellings(_parser.parse(pattern), True)[0]:
        if min(map(len, stretch)) >= 3:
            asked = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in stretch}
            # A spelling that asks for more than another adds nothing to the OR.
            query.append(sorted(sorted(a) for a in asked if not any(b < a for b in asked)))
    return query


def postings(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """doc_id, trigram: the index, for the trigrams of ``vocabulary``."""
    # The variable of a lambda is computed once: a plain column would be put into every branch and lower-cased there again.
    once = F.array(F.lower(F.col("text").cast("string")))
    present = F.transform(once, lambda low: F.array_compact(F.array(*[F.when(low.contains(t), F.lit(t)) for t in vocabulary])))[0]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.explode(present).alias("trigram"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """__id, __rules: the rules whose trigram query a document's postings satisfy."""
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern))}
    vocabulary = sorted({t for q in queries.values() for stretch in q for spelling in stretch for t in spelling})
    found = postings(docs, vocabulary).groupBy("doc_id").agg(F.collect_set("trigram").alias("found"))

    def holds(query: list[list[list[str]]]) -> Column:
        both = F.lit(True)
        for stretch in query:
            either = F.lit(False)
            for spelling in stretch:
                every = F.lit(True)
                for t in spelling:
                    every &= F.array_contains("found", t)
                either |= every
            both &= either
        return both

    fitting = F.array_compact(F.array(*[F.when(holds(q), F.lit(kind)) for kind, q in sorted(queries.items())]))
    return found.select(F.col("doc_id").alias("__id"), fitting.alias("__rules")).where(F.size("__rules") > 0)


def folded(items: Column, item: str, step) -> Column:
    """struct<at:int,found:array<``item``>>: ``step(state, x)`` over ``items``, from 0 and an empty array.

    An array that grows is copied at each step, so chunks are folded by themselves and joined.
    """
    kind = f"struct<at:int,found:array<{item}>>"

    def whole(every: Column) -> Column:
        def add(state: Column, begin: Column) -> Column:
            fresh = F.struct(state["at"].alias("at"), F.array().cast(f"array<{item}>").alias("found"))
            chunk = F.aggregate(F.slice(every, begin + 1, CHUNK), fresh, step)
            return F.transform(F.array(chunk), lambda c: F.struct(c["at"].alias("at"), F.concat(state["found"], c["found"]).alias("found")))[0]

        begins = F.sequence(F.lit(0), F.greatest(F.size(every), F.lit(1)) - 1, F.lit(CHUNK))
        return F.aggregate(begins, F.struct(F.lit(0).alias("at"), F.array().alias("found")).cast(kind), add)

    return F.transform(F.array(items), whole)[0]  # the items are a variable of the lambda, computed once a row


def matches(text: Column, rule: Rule, order: int) -> Column:
    """array<struct<start, order, end, kind>> of a rule's matches: texts between the matches and the matches give the places."""
    between, found = F.split(text, rule.pattern, -1), F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["before"])
        end = start + F.length(pair["match"])
        size = F.length(F.regexp_extract(pair["match"], rule.pattern, rule.group)) if rule.group else F.length(pair["match"])
        span = F.struct(start.alias("start"), F.lit(order).alias("order"), end.alias("end"), F.lit(rule.kind).alias("kind"), size.alias("size"))
        return F.struct(end.alias("at"), F.concat(state["found"], F.array(span)).alias("found"))

    # The text behind the last match has none of its own.
    pairs = F.arrays_zip(F.slice(between, 1, F.size(found)).alias("before"), found.alias("match"))
    return F.filter(folded(pairs, SPAN, step)["found"], lambda s: s["size"] >= rule.least)


def spans(docs: DataFrame, rules: tuple[Rule, ...] = BASE + ADDED, keep: bool = False) -> DataFrame:
    """Each row's doc_id and ``spans``: array<struct<start, order, end, kind, size>> by start, then order of the rules.

    With ``keep`` all columns stay and the array is called ``__spans``.
    """
    scanning = [r.kind for r in rules if not trigram_query(r.pattern)]
    rows = docs if keep else docs.select("doc_id", "text")
    rows = rows.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("text", F.col("text").cast("string"))
    joined = rows.join(candidates(docs, rules), F.col("doc_id").eqNullSafe(F.col("__id")), "left")
    none = F.array().cast(f"array<{SPAN}>")
    parts = []
    for order, rule in enumerate(rules):
        wanted = F.col("text").isNotNull() if rule.kind in scanning else F.array_contains("__rules", rule.kind)
        parts.append(F.when(wanted & F.col("text").rlike(rule.pattern), matches(F.col("text"), rule, order)).otherwise(none))
    out = joined.withColumn("__spans", F.array_sort(F.concat(*parts))).drop("__id", "__rules")
    return out if keep else out.select("doc_id", F.col("__spans").alias("spans"))


def written(found: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(docs: DataFrame) -> DataFrame:
    found = spans(docs)
    base = F.filter("spans", lambda s: s["order"] < len(BASE))

    def count(order: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["order"] == order)).cast("long")

    return found.select(
        "doc_id",
        *[count(i).alias(f"n_{r.kind}") for i, r in enumerate(BASE)],
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )


def redacted(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of ``text`` (overlapping ones as one) replaced by ``mark``.

    The stretches between the spans are cut out of blocks of the text, so a stretch costs its length, not that of the text.
    """

    def step(state: Column, s: Column) -> Column:
        gap = F.array(F.struct(state["at"].alias("start"), s["start"].alias("end")))
        gaps = F.when(s["start"] >= state["at"], F.concat(state["found"], gap)).otherwise(state["found"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), gaps.alias("found"))

    def joined(blocks: Column, done: Column) -> Column:
        def stretch(gap: Column) -> Column:
            first, last = F.floor(gap["start"] / BLOCK).cast("int"), F.floor(gap["end"] / BLOCK).cast("int")
            near = F.array_join(F.slice(blocks, first + 1, last - first + 1), "")
            return F.substring(near, gap["start"] - first * BLOCK + 1, gap["end"] - gap["start"])

        end = F.struct(done["at"].alias("start"), F.length("text").alias("end"))
        return F.array_join(F.transform(F.concat(done["found"], F.array(end)), stretch), mark)

    # Both are variables of a lambda, so they are computed once a row.
    parts = F.array(F.struct(F.regexp_extract_all("text", F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)).alias("blocks"), folded(F.col("__spans"), "struct<start:int,end:int>", step).alias("done")))
    clean = F.transform(parts, lambda p: joined(p["blocks"], p["done"]))[0]
    return spans(docs, keep=True).withColumn("text", F.when(F.size("__spans") > 0, clean).otherwise(F.col("text"))).drop("__spans")
