"""The operators of this folder as named queries, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.bpe import round_trip
from tidegate.llm.decontaminate import decontaminate
from tidegate.llm.grammar import read_tokens, shard_starts, write_tokens
from tidegate.llm.language_id import held_out, identify, train_profiles, trained_on
from tidegate.llm.license_scan import license_scan
from tidegate.llm.line_quality import judge_lines, train_field
from tidegate.llm.manifest import merkle_manifest
from tidegate.llm.near_dups import near_duplicates
from tidegate.llm.ordinal import graded, score_documents, train_ordinal
from tidegate.llm.substring_dedup import substring_dedup
from tidegate.llm.suffix_dedup import suffix_dedup
from tidegate.llm.tables import documents, table
from tidegate.llm.token_counts import token_counts
from tidegate.llm.trie import prefix_trie, regrown, sequences
from tidegate.sources.package import send_package
from tidegate.sources.shared import fresh_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        send_package(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"), F.size("spans").cast("long").alias("n_spans"))


SQL["op1_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS r FROM win) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM later),
each AS (SELECT doc_id, w[p] AS word, p FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d)),
marked AS (SELECT e.doc_id, e.word, e.p, g.p IS NOT NULL AS cut FROM each e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.p = g.p),
edged AS (SELECT *, cut AND NOT lag(cut, 1, FALSE) OVER (PARTITION BY doc_id ORDER BY p) AS opens FROM marked),
kept AS (SELECT doc_id, count(*) FILTER (WHERE cut) AS n_removed, count(*) FILTER (WHERE opens) AS n_spans,
         string_agg(word, ' ' ORDER BY p) FILTER (WHERE NOT cut) AS body FROM edged GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id"""


@query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup(documents(spark, sf_dir))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


SQL["op2_suffix_dedup"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
blocks AS (SELECT doc_id, s, substr(h, 2 * s + 1, 2 * (512 + 49)) AS part FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2, 512)) AS s FROM d)),
win AS (SELECT doc_id, s + j AS i, substr(part, 2 * j + 1, 100) AS k
        FROM (SELECT doc_id, s, part, unnest(range(0, least(512, len(part) // 2 - 49))) AS j FROM blocks)),
firsts AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k),
later AS (SELECT doc_id, i FROM win JOIN firsts USING (k) WHERE m < doc_id),
edged AS (SELECT *, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 50 THEN 0 ELSE 1 END AS opens FROM later),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM edged),
runs AS (SELECT doc_id, min(i) AS b, max(i) + 50 AS e FROM numbered GROUP BY doc_id, run),
before AS (SELECT *, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 0) AS from_byte FROM runs),
cut AS (SELECT doc_id, sum(e - b) AS n_removed, count(*) AS n_spans, max(e) AS tail,
        string_agg(substr(h, 2 * from_byte + 1, 2 * (b - from_byte)), '' ORDER BY b) AS body FROM before JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(body, '') || substr(h, 2 * coalesce(tail, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN cut ON d.doc_id = cut.doc_id"""


#: A vocabulary file that all executors' hosts need not hold: the driver reads it.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"


@query
def op9_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = round_trip(documents(spark, sf_dir), VOCABULARY)
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = identify(docs, train_profiles(trained_on(docs)))
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


SQL["op3_decontamination"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS k
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS k
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes)),
hit AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.n = bw.n),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places ON d.doc_id = places.doc_id LEFT JOIN items ON d.doc_id = items.doc_id"""


@query
def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(documents(spark, sf_dir))
    return out.select("doc_id", "group_id", "content_id", "n_links", (F.col("doc_id") == F.col("group_id")).alias("kept"))


@query
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir)).withColumn("n_spans", F.size("spans").cast("long")).drop("spans")


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return judge_lines(docs, train_field(docs, table(spark, sf_dir, "labels"))).drop("line_labels")


@query
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return score_documents(docs, train_ordinal(docs, graded(table(spark, sf_dir, "labels"))))


@query
def op5_grammar_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "tokens")
    write_tokens(documents(spark, sf_dir), VOCABULARY, path)
    rows = read_tokens(spark, path).select("doc_id", "shard", "part", "place", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    return rows.join(shard_starts(spark, path), ["shard", "part"]).select("doc_id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")


#: The CRC of a text of ASCII characters, bit by bit.
CRC32 = """xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten([[CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0] for c in string_split({0}, '')])),
           lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1))), CAST(4294967295 AS BIGINT))"""


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = merkle_manifest(documents(spark, sf_dir))
    siblings = F.concat_ws("", F.transform("proof", lambda step: step["others"]))
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), "folded_root", "verified")


def _manifest_sql(levels: int = 6) -> str:
    """Trees of up to 16**levels leaves and groups, level by level; a tree that has its root stays as it is."""

    def value(column: str, text: str | None = None) -> str:
        text = text or f"CAST({column} AS VARCHAR)"
        return f"coalesce(strlen({text}) || ':' || {text}, '-')"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    heads = " || ".join(value(c) for c in ("doc_id", "source", "lang", "n_chars"))
    steps = [
        f"""d AS (SELECT doc_id, source, sha256({heads} || {value("text", "text")}) AS leaf,
            CASE WHEN {CRC32.format("CAST(doc_id AS VARCHAR)")} % 5 = 0 THEN sha256({heads} || {value("text", lower)}) END AS changed FROM documents)""",
        "leaves AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r, count(*) OVER (PARTITION BY source) AS n FROM d)",
        "a0 AS (SELECT source AS g, r, leaf AS h, n FROM leaves)",
    ]

    def tree(name: str) -> None:
        for k in range(levels):
            steps.append(f"{name}r{k} AS (SELECT g, r // 16 AS p, n, list(h ORDER BY r) AS hs FROM {name}{k} GROUP BY g, r // 16, n)")
            steps.append(f"{name}{k + 1} AS (SELECT g, p AS r, CASE WHEN n = 1 THEN hs[1] ELSE sha256(array_to_string(hs, '')) END AS h, (n + 15) // 16 AS n FROM {name}r{k})")

    def climb(name: str, table: str, rank: str, group: str) -> str:
        for k in range(levels):
            at = f"CAST(({rank} >> {4 * k}) % 16 AS BIGINT)"
            low, high = f"array_to_string(hs[1:{at}], '')", f"array_to_string(hs[{at} + 2:], '')"
            node = f"CASE WHEN t.n = 1 THEN node ELSE sha256({low} || node || {high}) END AS node"
            proof = f"proof || CASE WHEN t.n = 1 THEN '' ELSE {low} || {high} END AS proof"
            following = f"{name}w{k}"
            steps.append(
                f"{following} AS (SELECT w.* EXCLUDE (node, proof), {node}, {proof} FROM {table} w JOIN {name}r{k} t ON w.{group} IS NOT DISTINCT FROM t.g AND w.{rank} >> {4 * k + 4} = t.p)"
            )
            table = following
        return table

    tree("a")
    steps.append(f"groups AS (SELECT g AS source, h AS subroot, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS gr, count(*) OVER () AS gn FROM a{levels})")
    steps.append("b0 AS (SELECT 0 AS g, gr AS r, subroot AS h, gn AS n FROM groups)")
    tree("b")
    steps.append("begun AS (SELECT l.doc_id, l.source, l.leaf, l.r, s.subroot, s.gr, 0 AS one, coalesce(changed, leaf) AS node, '' AS proof FROM leaves l JOIN groups s ON l.source IS NOT DISTINCT FROM s.source)")
    done = climb("b", climb("a", "begun", "r", "source"), "gr", "one")
    return f"""WITH {", ".join(steps)}
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, node AS folded_root, node = h AS verified FROM {done}, (SELECT h FROM b{levels})"""


SQL["op11_merkle_manifest"] = _manifest_sql()


@query
def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(regrown(sequences(table(spark, sf_dir, "conversations"))))


SQL["op13_conversation_trie"] = f"""
WITH t AS (SELECT conv_id, turn, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id, strlen(coalesce(text, '')) AS size
           FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(struct_pack(id := id, size := size) ORDER BY turn NULLS FIRST, id) AS turns FROM t GROUP BY conv_id),
shared AS (SELECT o.conv_id, CAST({CRC32.format("CAST(o.conv_id AS VARCHAR)")} % 9 AS BIGINT) AS h, o.turns, coalesce(b.turns, []) AS base
           FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5),
rebuilt AS (SELECT conv_id, list_concat(base[1:h], turns[h + 1:]) AS turns FROM shared),
way AS (SELECT conv_id, depth, sha256(array_to_string([x.id for x in turns[1:depth]], '')) AS node, CASE WHEN depth > 0 THEN turns[depth].size ELSE 0 END AS size,
               len(turns) = depth AS last
        FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM rebuilt)),
nodes AS (SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
                 sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE last), '')) AS ends_sha256
          FROM way GROUP BY node, depth),
linked AS (SELECT n.*, p.node AS parent FROM nodes n LEFT JOIN way p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1),
counted AS (SELECT l.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM linked c WHERE c.parent = l.node) AS n_children FROM linked l LEFT JOIN nodes p ON p.node = l.parent),
sums AS (SELECT w.node, sum((c.n_convs - 1) * c.size) AS saved, count(*) FILTER (WHERE c.n_children = 0) AS n_leaves
         FROM counted c JOIN way w ON w.conv_id = c.conv_id AND w.depth <= c.depth GROUP BY w.node)
SELECT conv_id, CAST(depth AS BIGINT) AS depth, parent_conv_id, CAST(n_convs AS BIGINT) AS n_convs, CAST(n_children AS BIGINT) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, ends_sha256
FROM counted JOIN sums USING (node)"""
