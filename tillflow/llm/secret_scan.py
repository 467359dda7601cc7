"""Secret scans with corpus-wide ownership frequency, in DataFrame operations only.

Every text is searched for three base kinds of candidates and for bare key-like
tokens. The hash of each candidate's value is counted over the whole corpus by
the distinct owners and repositories that hold it. A value held by ``widely`` or
more owners is a widely copied example; any other is a live-looking credential.
Base spans are always reported; bare tokens only where they look live and lie in
no base span.

Matches are leftmost and do not overlap within a kind; positions count code
points, ends exclusive. A kind's positions come from the lengths of its matches
and of the text between them.

Hot values: counting combines on the map side, one row per value, owner and
repository, and the join back has one row per value on its small side.

Defined results: a null text is empty and has no spans; a null owner or
repository is a value of its own; repeated rows are scanned alike and count as
one owner; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.tables import settled, text_column

# Kind, pattern, least length of the value, in the order of the kinds.
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
KINDS = [
    ("assign", ASSIGN, 6),
    ("access", "AKIA[A-Z0-9]{16,}", 20),
    ("hex", "(?<![0-9a-f])[0-9a-f]{24,}", 24),
]
BARE = ("bare", "(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}", 20)
WIDELY = 5
SPAN = "array<struct<start:int,kind_no:int,kind:string,end:int,value:string>>"


def _spans(text: Column, found: Column, number: int, kind: str, pattern: str, least: int) -> Column:
    """The matches ``found`` as spans: each starts where the rest before it and the match before that end."""
    rest = F.split(text, pattern, -1)
    pairs = F.arrays_zip(found.alias("found"), F.slice(rest, F.lit(1), F.size(found)).alias("rest"))

    def step(done: Column, pair: Column) -> Column:
        start = done["at"] + F.length(pair["rest"])
        end = start + F.length(pair["found"])
        value = F.regexp_extract(pair["found"], pattern, 2) if kind == "assign" else pair["found"]
        span = F.struct(
            start.alias("start"), F.lit(number).alias("kind_no"), F.lit(kind).alias("kind"),
            end.alias("end"), value.alias("value"),
        )
        return F.struct(end.alias("at"), F.concat(done["spans"], F.array(span)).alias("spans"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))
    spans = F.aggregate(pairs, start, step, lambda done: done["spans"])
    kept = F.filter(spans, lambda s: F.length(s["value"]) >= least)
    return F.when(F.size(found) > 0, kept).otherwise(F.array().cast(SPAN))


def secret_spans(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    owner: str = "source",
    repository: str = "lang",
    widely: int = WIDELY,
) -> DataFrame:
    """Per row: ``doc_id``, ``text_key`` (hash of the text) and ``spans``.

    ``spans`` is sorted by start, then kind, and holds ``start``, ``kind_no``,
    ``kind``, ``end``, ``value``, ``owners``, ``repositories`` and ``live``.
    """
    body = text_column(text)
    kinds = [*KINDS, BARE]
    found = docs.select(
        F.col(id).alias("doc_id"), F.col(owner).alias("owner"), F.col(repository).alias("repository"),
        body.alias("text"),
        *[F.regexp_extract_all(body, F.lit(p), F.lit(0)).alias(k) for k, p, _ in kinds],
    )
    spans = {
        kind: _spans(F.col("text"), F.col(kind), number, kind, pattern, least)
        for number, (kind, pattern, least) in enumerate(kinds)
    }
    keylike = F.filter(spans["bare"], lambda s: (
        s["value"].rlike("[0-9]") & s["value"].rlike("[A-Z]") & s["value"].rlike("[a-z]")))
    scanned = found.select(
        "doc_id", "owner", "repository", F.xxhash64("text").alias("text_key"),
        F.concat(*[spans[kind] for kind, _, _ in KINDS]).alias("base"), keylike.alias("keylike"),
    ).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "owner", "repository", "text_key",
        F.concat("base", F.filter("keylike", lambda k: ~F.exists(
            "base", lambda b: (b["start"] <= k["start"]) & (b["end"] >= k["end"])
        ))).alias("spans"),
    )
    scanned = settled(scanned)

    each = scanned.where(F.size("spans") > 0).select(
        "row", "owner", "repository", F.explode("spans").alias("span")
    ).withColumn("hash", F.sha2("span.value", 256))
    held = (
        each.groupBy("hash", "owner", "repository").agg(F.lit(1).alias("one"))
        .groupBy("hash", "owner").agg(F.count("*").alias("repositories"))
        .groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))
    )
    judged = each.join(held, "hash").withColumn("live", F.col("owners") < widely).where(
        (F.col("span.kind") != BARE[0]) | F.col("live")
    ).groupBy("row").agg(F.array_sort(F.collect_list(F.struct(
        "span.start", "span.kind_no", "span.kind", "span.end", "span.value",
        "owners", "repositories", "live",
    ))).alias("spans"))
    none = F.array().cast(judged.schema["spans"].dataType)
    return (
        scanned.drop("spans").join(judged, "row", "left")
        .select("doc_id", "text_key", F.coalesce("spans", none).alias("spans"))
    )


def redact_live(
    docs: DataFrame, id: str = "doc_id", text: str = "text", mark: str = "[SECRET]", **options
) -> DataFrame:
    """``docs`` with the value of every live-looking credential replaced by ``mark``.

    Widely copied examples and all other text stay; so do null texts. Columns
    ``_doc``, ``_key`` and ``_live`` are dropped.
    """
    docs = docs.drop("_doc", "_key", "_live")
    live = (
        secret_spans(docs, id, text, **options)
        .select("doc_id", "text_key", F.filter("spans", lambda s: s["live"]).alias("_live"))
        .where(F.size("_live") > 0)
        .dropDuplicates(["doc_id", "text_key"])
        .select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"), "_live")
    )
    joined = docs.join(
        live,
        F.col(id).eqNullSafe(F.col("_doc")) & (F.xxhash64(text_column(text)) == F.col("_key")), "left",
    )
    # A value stands at its span's end, before a mark already set by a span that overlaps it.
    parts = F.aggregate(
        "_live",
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda done, s: F.when(
            s["end"] - F.length(s["value"]) < done["at"],
            F.struct(F.greatest(done["at"], s["end"]).alias("at"), done["out"].alias("out")),
        ).otherwise(F.struct(
            s["end"].alias("at"),
            F.concat(
                done["out"],
                F.substring(F.col(text), done["at"] + 1, s["end"] - F.length(s["value"]) - done["at"]),
                F.lit(mark),
            ).alias("out"),
        )),
        lambda done: F.concat(done["out"], F.substring(F.col(text), done["at"] + 1, F.length(text))),
    )
    redacted = F.when(F.col("_live").isNull(), F.col(text)).otherwise(parts)
    return joined.select(*[
        (redacted if name == text else F.col(f"`{name}`")).alias(name) for name in docs.columns
    ])


def oracle(widely: int = WIDELY) -> str:
    """The same spans in DuckDB's SQL, from the table ``documents``."""
    kinds = [(k, p.replace("(?<![0-9a-f])", "").replace("(?<![A-Za-z0-9+/_=-])", ""), n)
             for k, p, n in [*KINDS, BARE]]
    parts = []
    for number, (kind, pattern, least) in enumerate(kinds):
        quoted = pattern.replace("'", "''")
        value = f"regexp_extract(m[i], '{quoted}', 2)" if kind == "assign" else "m[i]"
        parts.append(f"""
        SELECT * FROM (
          SELECT doc_id, source, lang, '{kind}' AS kind, {number} AS no, {value} AS value,
            coalesce(list_sum(list_transform(r[1:i], lambda x: length(x))), 0)
              + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) AS s,
            length(m[i]) AS n
          FROM (
            SELECT doc_id, source, lang, m, r, unnest(range(1, len(m) + 1)) AS i FROM (
              SELECT doc_id, source, lang, regexp_extract_all(text, '{quoted}') AS m,
                string_split_regex(text, '{quoted}') AS r
              FROM (SELECT doc_id, source, lang, coalesce(text, '') AS text FROM documents))
          ) t
        ) WHERE length(value) >= {least}""")
    return f"""
    WITH found AS ({" UNION ALL ".join(parts)}),
    each AS (
      SELECT f.* FROM found f WHERE kind <> 'bare' OR (
        regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Z]')
        AND regexp_matches(value, '[a-z]')
        AND NOT EXISTS (SELECT 1 FROM found b WHERE b.kind <> 'bare' AND b.doc_id = f.doc_id
          AND b.s <= f.s AND b.s + b.n >= f.s + f.n))
    ),
    held AS (
      SELECT value, count(*) AS owners FROM (SELECT DISTINCT value, source FROM each) GROUP BY value
    ),
    kept AS (
      SELECT each.*, kind || ':' || s || ':' || (s + n) AS label, owners < {widely} AS live
      FROM each JOIN held USING (value) WHERE kind <> 'bare' OR owners < {widely}
    ),
    by_doc AS (
      SELECT doc_id,
        count(*) FILTER (kind = 'assign') AS n_assign,
        count(*) FILTER (kind = 'access') AS n_access,
        count(*) FILTER (kind = 'hex') AS n_hex,
        string_agg(label, ',' ORDER BY s, no) FILTER (kind <> 'bare') AS base,
        string_agg(label, ',' ORDER BY s, no) AS spans,
        count(*) FILTER (live) AS n_live
      FROM kept GROUP BY doc_id
    )
    SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
      coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
      coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live
    FROM documents d LEFT JOIN by_doc USING (doc_id)"""
