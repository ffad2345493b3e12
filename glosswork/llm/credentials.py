r"""Secrets in texts: fixed patterns, and multipart credentials linked by position.

Base spans come from three patterns (assignments, access identifiers, hex
runs), leftmost and non-overlapping per pattern. Two further kinds are too weak
to report alone: bare key-like tokens and endpoints. They are reported only
where a complementary part lies in the same scope, the ``reach`` code points
around a part: a token near an access identifier, or near an endpoint that
itself is near an assignment; an endpoint near an access identifier, a linked
token or an assignment. Scopes and candidates meet in an interval join on
(document, block of ``reach`` code points); semi joins keep each candidate once
however many partners it has, so no pairs are built.

All steps are DataFrame functions. Spans of a pattern are counted from the
texts between its matches; the patterns run once over the texts, and the narrow
result is staged before it joins with itself. Rows meet on a digest of id and
text, so a table with repeated or null ids links only inside one text.

Defined results: a token is a whole run of at least 32 key characters, an
endpoint a whole run of at least 4 characters after its scheme; a null text is empty and has no spans; every row of the input
gives one row, repeated rows included; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from glosswork.session import stage

# Fixed patterns of the base kinds and the least length of what they match.
ASSIGN = "(?i:(password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]+"
HEX_RUN = "[0-9a-f]{24,}"
ASSIGN_MIN, ACCESS_MIN = 6, 20
# Weak parts: key-like tokens with a digit and a letter, and endpoints, both of any length.
TOKEN = "(?<![A-Za-z0-9/+=_-])(?=[A-Za-z/+=_-]*+[0-9])(?=[0-9/+=_-]*+[A-Za-z])[A-Za-z0-9/+=_-]{32,}+"
ENDPOINT = "(?:https?|s3|jdbc:[a-z]+|[a-z]+\\+ssh)://[A-Za-z0-9._~:@/?&=%+-]{4,}+"
KINDS = ("assign", "access", "hex", "token", "endpoint")
REACH = 400
# Matches added up at a time.
GROUP = 128

_SPAN = "struct<start:int,end:int>"


def spans(text: Column, pattern: str) -> Column:
    """Code-point spans of all matches of ``pattern``.

    The texts between matches give the positions. They add up in groups of
    matches, then over groups: an array that grows with every match of a text
    would be copied for each of them.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.slice(F.split(text, pattern, -1), 1, F.size(found))
    steps = F.zip_with(found, between, lambda m, g: F.struct(F.length(g).alias("gap"), F.length(m).alias("size")))
    return _bound(steps, _located)


def _bound(value: Column, then) -> Column:
    """``then`` of a value that is computed once, though lambdas use it."""
    return F.transform(F.array(value), then)[0]


def _located(steps: Column) -> Column:
    firsts = F.when(F.size(steps) > 0, F.sequence(F.lit(1), F.size(steps), F.lit(GROUP))).otherwise(
        F.array().cast("array<int>")
    )
    groups = F.transform(firsts, lambda i: _running(F.slice(steps, i, F.lit(GROUP))))
    moved = lambda part, at: F.transform(
        part["out"], lambda s: F.struct((s["start"] + at).alias("start"), (s["end"] + at).alias("end"))
    )
    return _bound(groups, lambda g: F.flatten(F.zip_with(g, _offsets(g), moved)))


def _running(steps: Column) -> Column:
    """Spans of a group from its own beginning, and its length."""
    return F.aggregate(
        steps,
        F.struct(F.lit(0).alias("at"), _none().alias("out")),
        lambda s, m: F.struct(
            (s["at"] + m["gap"] + m["size"]).alias("at"),
            F.concat(
                s["out"],
                F.array(
                    F.struct((s["at"] + m["gap"]).alias("start"), (s["at"] + m["gap"] + m["size"]).alias("end"))
                ),
            ).alias("out"),
        ),
    )


def _offsets(groups: Column) -> Column:
    return F.aggregate(
        groups,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
        lambda s, g: F.struct((s["at"] + g["at"]).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")),
        lambda s: s["out"],
    )


def _none() -> Column:
    return F.array().cast(f"array<{_SPAN}>")


def _assign_spans(text: Column) -> Column:
    """Spans of assignments whose value has at least ASSIGN_MIN characters."""
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    kept = F.filter(
        F.arrays_zip(spans(text, ASSIGN).alias("span"), values.alias("value")),
        lambda m: F.length(m["value"]) >= ASSIGN_MIN,
    )
    return F.transform(kept, lambda m: m["span"])


def _long(found: Column, least: int) -> Column:
    return F.filter(found, lambda s: s["end"] - s["start"] >= least)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One narrow row per document: ``id``, ``key`` and an array of spans per kind."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    t = F.col("text")
    some = lambda test, found: F.when(test, found).otherwise(_none())
    return rows.select(
        "id",
        F.md5(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("null")), F.lit("\n"), t)).alias("key"),
        some(t.rlike(ASSIGN), _assign_spans(t)).alias("assign"),
        some(t.contains("AKIA"), _long(spans(t, ACCESS), ACCESS_MIN)).alias("access"),
        some(t.rlike(HEX_RUN), spans(t, HEX_RUN)).alias("hex"),
        some(t.rlike(TOKEN), spans(t, TOKEN)).alias("token"),
        some(t.contains("://"), spans(t, ENDPOINT)).alias("endpoint"),
    )


def _parts(scanned: DataFrame, *kinds: str) -> DataFrame:
    """Spans of some kinds as rows ``key, start, end``, one for each distinct span."""
    found = F.flatten(F.array(*[F.col(k) for k in kinds]))
    return scanned.filter(F.size(found) > 0).select("key", F.inline(found)).distinct()


def near(candidates: DataFrame, parts: DataFrame, reach: int = REACH, block: int = REACH) -> DataFrame:
    """The candidates that overlap the scope of some part: an interval semi join.

    A scope is the part and ``reach`` code points on either side. Scopes enter
    every block they touch; a candidate enters the blocks it touches.
    """
    blocks = lambda lo, hi: F.explode(F.sequence(F.floor(lo / block), F.floor(hi / block)))
    scopes = parts.select(
        F.col("key").alias("p_key"), (F.col("start") - reach).alias("lo"), (F.col("end") + reach).alias("hi")
    ).select("*", blocks(F.greatest(F.col("lo"), F.lit(0)), F.col("hi")).alias("p_block"))
    placed = candidates.select("*", blocks(F.col("start"), F.col("end")).alias("block"))
    met = (
        (F.col("key") == F.col("p_key"))
        & (F.col("block") == F.col("p_block"))
        & (F.col("start") < F.col("hi"))
        & (F.col("end") > F.col("lo"))
    )
    return placed.join(scopes, met, "left_semi").drop("block").distinct()


def linked_spans(scanned: DataFrame, reach: int = REACH) -> DataFrame:
    """``key, kind, start, end`` of the weak candidates that have a partner."""
    tokens, endpoints = _parts(scanned, "token"), _parts(scanned, "endpoint")
    base = _parts(scanned, "assign", "access", "hex")
    covered = near(tokens, base, 0)
    tokens = tokens.join(covered, ["key", "start", "end"], "left_anti")  # already reported as a base span
    identifiers, assigned = _parts(scanned, "access"), _parts(scanned, "assign")
    served = near(endpoints, assigned, reach)
    tokens = near(tokens, identifiers.unionByName(served), reach)
    partners = identifiers.unionByName(assigned).unionByName(tokens)
    endpoints = near(endpoints, partners, reach)
    return tokens.withColumn("kind", F.lit("token")).unionByName(endpoints.withColumn("kind", F.lit("endpoint")))


def _joined(found: Column) -> Column:
    """``kind:start:end`` by start, then kind in the order of KINDS."""
    shown = F.transform(
        F.array_sort(found),
        lambda s: F.concat_ws(
            ":", F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["rank"]), s["start"].cast("string"), s["end"].cast("string")
        ),
    )
    return F.array_join(shown, ",")


def _ranked(found: Column, kind: str) -> Column:
    rank = F.lit(KINDS.index(kind) + 1)
    return F.transform(found, lambda s: F.struct(s["start"].alias("start"), rank.alias("rank"), s["end"].alias("end")))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """One row per document: base spans per kind, linked spans, both as text."""
    scanned = stage(scan(docs, id_col, text_col), "credentials")
    rank = F.when(F.col("kind") == "token", F.lit(KINDS.index("token") + 1)).otherwise(KINDS.index("endpoint") + 1)
    linked = (
        linked_spans(scanned, reach)
        .groupBy("key")
        .agg(F.collect_list(F.struct("start", rank.alias("rank"), "end")).alias("linked"))
    )
    base = F.flatten(F.array(*[_ranked(F.col(k), k) for k in KINDS[:3]]))
    every = F.concat(base, F.coalesce(F.col("linked"), F.array().cast("array<struct<start:int,rank:int,end:int>>")))
    return scanned.join(linked, "key", "left").select(
        F.col("id").alias(id_col),
        *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS[:3]],
        _joined(base).alias("base_spans"),
        _joined(every).alias("spans"),
    )
