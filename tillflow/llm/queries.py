"""The registered queries: each operator over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm import secret_scan
from tillflow.llm.bpe import encode_documents
from tillflow.llm.collocations import best_collocations, collocations
from tillflow.llm.conversation_trie import conversation_trie
from tillflow.llm.decontaminate import match_items
from tillflow.llm.debruijn import drop_repeated_words
from tillflow.llm.labelled import crc_fold
from tillflow.llm.packing import pack_documents
from tillflow.llm.quality import fit_quality, score_quality
from tillflow.llm.simhash import near_duplicate_components
from tillflow.llm.suffix_dedup import drop_repeated_bytes
from tillflow.llm.tables import scratch_folder, table
from tillflow.llm.token_files import read_token_files, write_token_files
from tillflow.llm.topk import top_k
from tillflow.llm.toxicity import fit_toxicity, score_toxicity

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the bytes of any 100-byte string that also starts earlier."""
    return drop_repeated_bytes(table(spark, sf_dir, "documents")).drop("kept")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids written to token files and read back."""
    path = scratch_folder(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path(WORD_BPE))
    return read_token_files(spark, path, per_document=zlib.crc32).withColumnRenamed("digest", "ids_crc32")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of each document, from labels of two folds of three."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_quality(docs, table(spark, sf_dir, "labels"), crc_fold("doc_id") != 1)
    return score_quality(docs, model).select(
        "doc_id",
        F.coalesce(crc_fold("doc_id") == 1, F.lit(False)).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= 0.5).cast("int").alias("predicted"),
    )


def op4_debruijn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the words of any 35-word window that occurs twice in the corpus."""
    return drop_repeated_words(table(spark, sf_dir, "documents")).drop("kept")


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best inner products of every twentieth vector among all, components in 64ths."""
    whole = F.transform("embedding", lambda x: F.floor(64 * x.cast("double")).cast("double"))
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.when(sound, whole).alias("embedding"))
    return top_k(rows, 20, F.col("vec_id") % 20 == 0)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chain low quality, toxic, severely toxic, from labels of two folds of three."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    chain = fit_toxicity(
        docs, labels, ["low_quality", "toxic"], severe_of="toxic", allowed=crc_fold("doc_id") != 1)
    return score_toxicity(docs, chain).select(
        "doc_id",
        F.coalesce(crc_fold("doc_id") == 1, F.lit(False)).alias("held_out"),
        F.col("_scores")[0].alias("low_quality"),
        F.col("_scores")[1].alias("score"),
        F.col("_scores")[2].alias("severe"),
        (F.col("_scores")[1] >= 0.5).cast("int").alias("predicted"),
    )


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside a benchmark window."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hit = F.aggregate("_match.spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return match_items(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id",
        F.col("_match.words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("_match.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "_match.items"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of each document; ``n_live`` counts those that look live by their owners."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] != secret_scan.BARE[0])
    return secret_scan.secret_spans(docs).select(
        "doc_id",
        count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"),
    )


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of three-word SimHash fingerprints within two bits."""
    found = near_duplicate_components(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of each document and what they decode to, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_documents(docs, public_tokenizers.path(WORD_BPE)).select(
        "doc_id",
        F.expr("octet_length(_ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("_ids", 256).alias("ids_sha256"),
        F.sha2("_decoded", 256).alias("decoded_sha256"),
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of two and three words of each language."""
    found = best_collocations(collocations(table(spark, sf_dir, "documents")), 2_000)
    return found.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids packed into sequences of 2,048."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack_documents(docs, public_tokenizers.path(BYTE_BPE), per_piece=zlib.crc32).withColumnRenamed(
        "digest", "ids_crc32")


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefixes that conversations share once their heads are taken from every fifth one."""
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    return conversation_trie(
        table(spark, sf_dir, "conversations"), head.cast("int"), F.expr("conv_id - conv_id % 5"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_token_files": op2_token_files,
    "op3_quality": op3_quality,
    "op4_debruijn": op4_debruijn,
    "op5_topk": op5_topk,
    "op6_toxicity": op6_toxicity,
    "op7_decontaminate": op7_decontaminate,
    "op8_secrets": op8_secrets,
    "op9_simhash": op9_simhash,
    "op10_bpe": op10_bpe,
    "op11_collocations": op11_collocations,
    "op12_packing": op12_packing,
    "op13_conversation_trie": op13_conversation_trie,
}

OP5_SQL = """
    WITH whole AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    each AS (SELECT vec_id, min(v) AS v FROM whole GROUP BY vec_id),
    scored AS (
      SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
      FROM each q JOIN each c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
      FROM scored)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20"""

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

OP1_SQL = """
    WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    starts AS (
      SELECT doc_id, p, md5_number(substr(h, 2 * p - 1, 200)) AS k
      FROM (SELECT doc_id, h, unnest(range(1, length(h) // 2 - 98)) AS p FROM d WHERE length(h) >= 200)),
    later AS (
      SELECT doc_id, p FROM (
        SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS n FROM starts)
      WHERE n > 1),
    grouped AS (
      SELECT doc_id, p, count(*) FILTER (fresh) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM (
        SELECT doc_id, p, coalesce(p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100, true) AS fresh
        FROM later)),
    spans AS (
      SELECT doc_id, span, min(p) AS s, max(p) + 100 AS e FROM grouped GROUP BY doc_id, span),
    cuts AS (
      SELECT doc_id, s, e, lag(e, 1, 1) OVER (PARTITION BY doc_id ORDER BY s) AS until FROM spans),
    sums AS (
      SELECT doc_id, sum(e - s)::BIGINT AS n_removed, count(*) AS n_spans, max(e) AS last,
        string_agg(substr(h, 2 * until - 1, 2 * (s - until)), '' ORDER BY s) AS kept
      FROM cuts JOIN d USING (doc_id) GROUP BY doc_id)
    SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed,
      coalesce(n_spans, 0) AS n_spans,
      sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 1) - 1))) AS kept_sha256
    FROM d LEFT JOIN sums USING (doc_id)"""

OP4_SQL = r"""
    WITH d AS (
      SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    edges AS (
      SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS s
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
    repeated AS (SELECT s FROM edges GROUP BY s HAVING count(*) > 1),
    gone AS (
      SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM edges JOIN repeated USING (s)),
    words AS (
      SELECT doc_id, p, w[p] AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d)),
    sums AS (
      SELECT doc_id, count(g.p) AS n_removed, string_agg(x, ' ' ORDER BY p) FILTER (g.p IS NULL) AS kept
      FROM words LEFT JOIN (SELECT doc_id, p FROM gone) g USING (doc_id, p) GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed,
      sha256(coalesce(kept, '')) AS kept_sha256
    FROM d LEFT JOIN sums USING (doc_id)"""

OP7_SQL = rf"""
    WITH d AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM documents),
    b AS (
      SELECT coalesce(item_id::VARCHAR, 'null') AS item, regexp_extract_all(
        translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM benchmark),
    windows AS (
      SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM (
        SELECT item, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
        FROM b WHERE len(w) > 0)),
    places AS (
      SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS s FROM (
        SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM d JOIN (SELECT DISTINCT k FROM windows) ON len(w) >= k)),
    hits AS (SELECT doc_id, i, k, item FROM places JOIN windows USING (s, k)),
    words AS (
      SELECT doc_id, count(DISTINCT p) AS n_hit
      FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
    items AS (
      SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS held
      FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
      sha256(coalesce(held, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""

OP11_SQL = rf"""
    WITH pieces AS (
      SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS piece, p FROM (
        SELECT lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[.,;:!?
-]')) AS p
        FROM documents)),
    words AS (SELECT lang, regexp_extract_all(p, '[^ 	]+') AS w FROM pieces),
    totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
    phrases AS (
      SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a FROM (
        SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM words JOIN (SELECT unnest([1, 2, 3]) AS k) ON len(w) >= k)
      GROUP BY ALL HAVING count(*) >= 10),
    cuts AS (
      SELECT lang, k, phrase, a, c, array_to_string(w[:c], ' ') AS p, array_to_string(w[c + 1:], ' ') AS q
      FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS c FROM phrases WHERE k > 1)),
    scored AS (
      SELECT s.lang, s.phrase, s.a, s.c, x.a AS l, y.a AS r,
        ((1000000::HUGEINT * s.a * s.a) // (x.a::HUGEINT * y.a))::BIGINT AS score
      FROM cuts s JOIN phrases x ON x.lang = s.lang AND x.phrase = s.p
        JOIN phrases y ON y.lang = s.lang AND y.phrase = s.q),
    weakest AS (
      SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) AS o FROM scored),
    longer AS (
      SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, max(a) AS most FROM (
        SELECT lang, a, string_split(phrase, ' ') AS w, unnest([1, 2]) AS i FROM phrases WHERE k = 3)
      GROUP BY ALL),
    ranked AS (
      SELECT lang, phrase, a, l, r, n, score,
        row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
      FROM weakest LEFT JOIN longer USING (lang, phrase) JOIN totals USING (lang)
      WHERE o = 1 AND (most IS NULL OR 100 * most < 50 * a))
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000"""

# DuckDB has no CRC-32: eight steps per byte over the decimal digits, as a fold.
CRC32_SQL = """list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
        lambda crc, byte: list_reduce(
          list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
          lambda y, zero: xor(y >> 1, (y & 1) * 3988292384)))"""

OP13_SQL = f"""
    WITH own AS (
      SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place,
        coalesce(role, '') AS role, coalesce(text, '') AS text
      FROM conversations WHERE conv_id IS NOT NULL),
    ids AS (
      SELECT conv_id, conv_id - conv_id % 5 AS base, xor({CRC32_SQL}, 4294967295) % 9 AS h
      FROM (SELECT DISTINCT conv_id FROM own)),
    joined AS (
      SELECT i.conv_id, 0 AS part, o.place, o.role, o.text
      FROM ids i JOIN own o ON o.conv_id = i.base AND o.place <= i.h
      UNION ALL
      SELECT i.conv_id, 1, o.place, o.role, o.text FROM ids i JOIN own o USING (conv_id) WHERE o.place > i.h),
    whole AS (
      SELECT i.conv_id, coalesce(list(sha256(length(role) || ':' || role || text) ORDER BY part, place)
          FILTER (j.conv_id IS NOT NULL), []) AS path,
        coalesce(list(strlen(text) ORDER BY part, place) FILTER (j.conv_id IS NOT NULL), []) AS sizes
      FROM ids i LEFT JOIN joined j USING (conv_id) GROUP BY i.conv_id),
    members AS (
      SELECT conv_id, d AS depth, path[:d] AS node, CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS bytes,
        d = len(path) AS ends
      FROM (SELECT *, unnest(range(0, len(path) + 1)) AS d FROM whole)),
    nodes AS (
      SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(bytes) AS saved,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
      FROM members GROUP BY node, depth),
    kids AS (SELECT node[:depth - 1] AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
    counted AS (SELECT *, coalesce(n_children, 0) AS children FROM nodes LEFT JOIN kids USING (node)),
    below AS (
      SELECT node[:d] AS node, sum(saved)::BIGINT AS saved_tokens, count(*) FILTER (children = 0) AS n_leaves
      FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM counted) GROUP BY 1)
    SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.children AS n_children, b.n_leaves,
      b.saved_tokens, c.ends_sha256
    FROM counted c JOIN below b USING (node)
      LEFT JOIN nodes p ON c.depth > 0 AND p.node = c.node[:c.depth - 1]"""

ORACLE: dict[str, str] = {
    "op1_suffix_dedup": OP1_SQL,
    "op4_debruijn": OP4_SQL,
    "op7_decontaminate": OP7_SQL,
    "op5_topk": OP5_SQL,
    "op8_secrets": secret_scan.oracle(),
    "op11_collocations": OP11_SQL,
    "op13_conversation_trie": OP13_SQL,
}
