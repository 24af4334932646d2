"""One registered query per operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import read_table
from . import (edit_counts, fingerprint, lsh_forest, merkle, packing, prefix_trie, quality_classifier, quality_rules, repeats, sentence_pieces, simhash,
               token_store, toxicity)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def vocabulary() -> str:
    return str(public_tokenizers.path("word_bpe_49k.json"))


@query
def op1_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edit_likeness(documents(spark, sf_dir))


@query
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_classifier.classify(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))
    return found.select("doc.doc_id", "held_out", "score", "predicted")


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), vocabulary())


@query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


@query
def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.removed(documents(spark, sf_dir))


ORACLE_SQL["op5_repeats"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (SELECT r, i, md5(substr(h, 2 * i + 1, {2 * repeats.LENGTH})) AS k
            FROM (SELECT r, h, unnest(range(0, len(h) // 2 - {repeats.LENGTH - 1})) AS i FROM d)),
again AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY k) > 1),
marked AS (SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + {repeats.LENGTH} THEN 0 ELSE 1 END AS opens FROM again),
spans AS (SELECT r, min(i) AS s, max(i) + {repeats.LENGTH} AS e
          FROM (SELECT r, i, sum(opens) OVER (PARTITION BY r ORDER BY i) AS n FROM marked) GROUP BY r, n),
gaps AS (SELECT r, s, e, coalesce(lag(e) OVER (PARTITION BY r ORDER BY s), 0) AS a FROM spans),
cut AS (SELECT r, count(*) AS n_spans, CAST(sum(e - s) AS BIGINT) AS n_removed, max(e) AS last,
               string_agg(substr(h, 2 * a + 1, 2 * (s - a)), '' ORDER BY s) AS kept
        FROM gaps JOIN d USING (r) GROUP BY r)
SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN last IS NULL THEN h ELSE kept || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN cut USING (r)"""


@query
def op6_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_counts.edited_counts(documents(spark, sf_dir), vocabulary())


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(documents(spark, sf_dir)).select("doc.doc_id", "*").drop("doc")


ORACLE_SQL["op7_quality_rules"] = quality_rules.oracle_sql()


@query
def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_store.write_store(documents(spark, sf_dir), vocabulary())
    return token_store.read_all(token_store.open_store(spark, path))


@query
def op9_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.round_trip(documents(spark, sf_dir), str(public_tokenizers.path("piece_bpe_32k.model")))


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.classify(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))
    return found.select("doc.doc_id", "held_out", "score", "predicted")


@query
def op11_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.near_duplicates(documents(spark, sf_dir))


def _crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit: each character, then its eight shifts (-1)."""
    return f"""xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split({text}, ''),
        lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS BIGINT)) ELSE c >> 1 END),
        CAST(4294967295 AS BIGINT))"""


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(read_table(spark, sf_dir, "conversations"))


ORACLE_SQL["op12_prefix_trie"] = f"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS p
           FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT c, c - c % 5 AS donor, {_crc32_sql("CAST(c AS VARCHAR)")} % 9 AS h FROM t),
r AS (SELECT ids.c, 0 AS part, t.p, t.role, t.text FROM ids JOIN t ON t.c = ids.donor AND t.p <= ids.h
      UNION ALL SELECT ids.c, 1, t.p, t.role, t.text FROM ids JOIN t ON t.c = ids.c AND t.p > ids.h),
q AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, p) AS d, count(*) OVER (PARTITION BY c) AS len,
             sha256(sha256(role) || sha256(text)) AS k, strlen(text) AS bytes,
             row_number() OVER (PARTITION BY c ORDER BY part, p) AS o FROM r),
paths AS (SELECT c, d, len, bytes, sha256(string_agg(k, '') OVER (PARTITION BY c ORDER BY d)) AS k FROM q
          UNION ALL SELECT ids.c, 0, coalesce(max(q.len), 0), 0, '' FROM ids LEFT JOIN q USING (c) GROUP BY ids.c),
up AS (SELECT *, lag(k) OVER (PARTITION BY c ORDER BY d) AS above FROM paths),
nodes AS (SELECT d, k, any_value(above) AS above, min(c) AS c, count(*) AS n, any_value(bytes) AS bytes,
                 coalesce(string_agg(CASE WHEN d = len THEN CAST(c AS VARCHAR) END, ',' ORDER BY c), '') AS ends FROM up GROUP BY d, k),
kids AS (SELECT d - 1 AS d, above AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
sums AS (SELECT paths.d, paths.k, count(*) FILTER (WHERE kids.n IS NULL) AS n_leaves, sum((nodes.n - 1) * nodes.bytes) AS saved
         FROM nodes LEFT JOIN kids USING (d, k) JOIN paths ON paths.c = nodes.c AND paths.d <= nodes.d GROUP BY ALL)
SELECT nodes.c AS conv_id, CAST(nodes.d AS BIGINT) AS depth, over_.c AS parent_conv_id, nodes.n AS n_convs, coalesce(kids.n, 0) AS n_children,
       sums.n_leaves, CAST(sums.saved AS BIGINT) AS saved_tokens, sha256(nodes.ends) AS ends_sha256
FROM nodes JOIN sums USING (d, k) LEFT JOIN kids USING (d, k) LEFT JOIN nodes over_ ON over_.d = nodes.d - 1 AND over_.k = nodes.above"""


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(documents(spark, sf_dir), merkle.every_seventh()).drop("proof")


def _leaf_sql(n_chars: str) -> str:
    fields = [n_chars if f == "n_chars" else f for f in merkle.FIELDS]
    return "sha256(" + " || ".join(f"coalesce(strlen(CAST({f} AS VARCHAR)) || ':' || CAST({f} AS VARCHAR), '-')" for f in fields) + ")"


def _levels_sql(name: str, leaves: str) -> str:
    """All nodes (tree, i, n, level, d) of the trees over ``leaves``."""
    return f"""{name} AS (
  SELECT tree, i, n, 0 AS level, d FROM {leaves}
  UNION ALL
  SELECT tree, i // 2, CAST(max((n + 1) // 2) AS BIGINT), max(level) + 1, sha256(string_agg(d, '' ORDER BY i)) FROM {name} WHERE n > 1 GROUP BY tree, i // 2)"""


ORACLE_SQL["op13_merkle_manifest"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf_sql("n_chars")} AS leaf,
    CASE WHEN {_crc32_sql("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN {_leaf_sql("(CAST(n_chars AS HUGEINT) + 1)")} ELSE {_leaf_sql("n_chars")} END AS shown
  FROM documents),
leaves AS (SELECT *, leaf AS d, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM d
           WINDOW w AS (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf)),
{_levels_sql("low", "leaves")},
langs AS (SELECT '' AS tree, tree AS lang, d, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM low WHERE n = 1),
{_levels_sql("high", "langs")},
steps AS (
  SELECT a.tree, a.i, b.level, b.i % 2 AS side, c.d AS other FROM leaves a JOIN low b ON b.tree = a.tree AND b.i = a.i >> b.level AND b.n > 1
    LEFT JOIN low c ON c.tree = b.tree AND c.level = b.level AND c.i = xor(b.i, 1)
  UNION ALL
  SELECT a.tree, a.i, 1000 + b.level, b.i % 2, c.d FROM leaves a JOIN langs l ON l.lang = a.tree JOIN high b ON b.i = l.i >> b.level AND b.n > 1
    LEFT JOIN high c ON c.level = b.level AND c.i = xor(b.i, 1)),
proofs AS (SELECT a.tree, a.i, any_value(a.doc_id) AS doc_id, any_value(a.leaf) AS leaf, any_value(a.shown) AS shown,
                  coalesce(string_agg(other, '' ORDER BY level), '') AS proof,
                  list(struct_pack(side := side, other := other) ORDER BY level) FILTER (WHERE level IS NOT NULL) AS path
           FROM leaves a LEFT JOIN steps s ON s.tree = a.tree AND s.i = a.i GROUP BY a.tree, a.i),
folds AS (
  SELECT tree, i, shown, 1 AS k, path FROM proofs
  UNION ALL
  SELECT tree, i, CASE WHEN path[k].other IS NULL THEN sha256(shown) WHEN path[k].side = 1 THEN sha256(path[k].other || shown)
                       ELSE sha256(shown || path[k].other) END, k + 1, path FROM folds WHERE k <= len(path))
SELECT p.doc_id, p.leaf, l.d AS subroot, h.d AS root, sha256(p.proof) AS proof_sha256, f.shown AS folded_root, f.shown = h.d AS verified
FROM proofs p JOIN langs l ON l.lang = p.tree JOIN high h ON h.n = 1
JOIN folds f ON f.tree = p.tree AND f.i = p.i AND f.k = coalesce(len(p.path), 0) + 1"""
