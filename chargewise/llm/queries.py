"""The registered queries of this subpackage: one thin query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chargewise.llm import ann, bpe, colloc, decontam, fingerprint, katz, langid, linededup, pii, repair, rlbwt, simhash, trie
from chargewise.llm.common import read_table, scratch


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents")).drop("root")


def op2_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(read_table(spark, sf_dir, "documents"), langid.is_held_out(F.col("doc_id"), 7, 2))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(read_table(spark, sf_dir, "documents"))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(
            ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    def of_kind(kind):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda x: x["base"])
    return found.select(
        "doc_id",
        *[of_kind(kind) for kind in pii.BASE_KINDS],
        F.sha2(listed(base), 256).alias("base_sha256"), listed("spans").alias("spans"))


def op4_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read_table(spark, sf_dir, "embeddings"))


def _tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = bpe.encode(read_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"), decoded=True)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = langid.is_held_out(F.col("doc_id"))
    model = langid.fit(docs.where(~held_out))
    return langid.classify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op7_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return linededup.remove_boilerplate(docs).select("doc_id", "n_lines", "n_removed", "text")


def op8_rlbwt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rlbwt.remove_repeats(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated_pairs(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op10_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "repair")
    repair.write(read_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"), path)
    return repair.checksums(spark, path)


def op11_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited(read_table(spark, sf_dir, "documents"))


def op12_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return colloc.collocations(read_table(spark, sf_dir, "documents"))


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(read_table(spark, sf_dir, "conversations"))


OP7_SQL = """
WITH lines AS (
  SELECT source, trim(unnest(string_split(text, chr(10)))) AS line FROM documents
), boiler AS (
  SELECT line FROM lines WHERE line <> '' GROUP BY line HAVING count(DISTINCT source) >= 10
), split AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS parts,
         (SELECT coalesce(list(line), []) FROM boiler) AS gone
  FROM documents
), kept AS (
  SELECT doc_id, text, parts, list_filter(parts, lambda x: NOT list_contains(gone, trim(x))) AS stay FROM split
)
SELECT doc_id,
       CASE WHEN text IS NULL THEN 0 ELSE len(parts) END AS n_lines,
       CASE WHEN text IS NULL THEN 0 ELSE len(parts) - len(stay) END AS n_removed,
       CASE WHEN text IS NULL THEN NULL ELSE array_to_string(stay, chr(10)) END AS text
FROM kept
"""

OP12_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL
), words AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces
), totals AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang
), sizes AS (
  SELECT unnest(range(1, 6)) AS k
), grams AS (
  SELECT lang, k, list_slice(w, i, i + k - 1) AS p
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words JOIN sizes ON len(w) >= k)
), f AS (
  SELECT lang, k, p, count(*) AS a FROM grams GROUP BY lang, k, p HAVING count(*) >= 100
), cuts AS (
  SELECT c.lang, c.k, c.p, c.a, t.n, x.k AS pos, x.a AS l, y.a AS r,
         ((1000::HUGEINT * c.a * t.n) // (x.a::HUGEINT * y.a))::BIGINT AS score
  FROM f c JOIN totals t ON t.lang = c.lang
  JOIN f x ON x.lang = c.lang AND x.k < c.k AND x.p = list_slice(c.p, 1, x.k)
  JOIN f y ON y.lang = c.lang AND y.k = c.k - x.k AND y.p = list_slice(c.p, x.k + 1, c.k)
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, pos) = 1
), kept AS (
  SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, n, score FROM best b
  WHERE NOT EXISTS (SELECT 1 FROM f x WHERE x.lang = b.lang AND x.k > b.k AND x.a >= b.a
                    AND contains(' ' || array_to_string(x.p, ' ') || ' ', ' ' || array_to_string(b.p, ' ') || ' '))
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM kept
QUALIFY rank <= 2000
"""

OP13_SQL = """
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), digits AS (
  SELECT conv_id, list_transform(string_split(conv_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT) AS codes
  FROM (SELECT DISTINCT conv_id FROM turns)
), convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base,
         xor(list_reduce(codes, lambda crc, b: list_reduce(range(8),
               lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(crc, b)),
             4294967295::BIGINT), 4294967295) % 6 AS h
  FROM digits
), rebuilt AS (
  SELECT c.conv_id, 0 AS part, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos < c.h
  UNION ALL
  SELECT c.conv_id, 1, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos >= c.h
), paths AS (
  SELECT conv_id, row_number() OVER so_far AS depth, length(text) AS chars,
         string_agg(md5(role) || md5(text), '') OVER so_far AS path
  FROM rebuilt WINDOW so_far AS (PARTITION BY conv_id ORDER BY part, pos)
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs
), ended AS (
  SELECT conv_id, max(depth) AS last FROM paths GROUP BY conv_id
), nodes AS (
  SELECT path, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
         CASE WHEN any_value(depth) > 0 THEN left(path, length(path) - 64) END AS above,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = last), '')) AS ends_sha256
  FROM paths JOIN ended USING (conv_id) GROUP BY path
), families AS (
  SELECT n.*, (SELECT count(*) FROM nodes c WHERE c.above = n.path) AS n_children FROM nodes n
), subtrees AS (
  SELECT left(path, 64 * d) AS path, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * chars) AS saved
  FROM (SELECT *, unnest(range(depth + 1)) AS d FROM families) GROUP BY 1
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves::BIGINT AS n_leaves,
       s.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM families n JOIN subtrees s ON s.path = n.path LEFT JOIN nodes p ON p.path = n.above
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_katz": op2_katz,
    "op3_pii": op3_pii,
    "op4_hilbert": op4_hilbert,
    "op5_bpe": op5_bpe,
    "op6_langid": op6_langid,
    "op7_linededup": op7_linededup,
    "op8_rlbwt": op8_rlbwt,
    "op9_decontam": op9_decontam,
    "op10_repair": op10_repair,
    "op11_scaled": op11_scaled,
    "op12_transducer": op12_transducer,
    "op13_trie": op13_trie,
}

ORACLE_SQL: dict[str, str] = {"op7_linededup": OP7_SQL, "op12_transducer": OP12_SQL, "op13_trie": OP13_SQL}
