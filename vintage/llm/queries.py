"""The operators of this package on the test tables, one query each, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintage.llm import ann, bpe, chat, langid, lexical, licenses, mixing, pii, quality, sharding, simhash, tokenfile, trie
from vintage.llm.staging import inline

WORD_VOCABULARY = "word_bpe_49k.json"
BYTE_VOCABULARY = "byte_bpe_50k.tiktoken"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the text with pseudonyms, and how many values of each kind were replaced."""
    clean = pii.pseudonyms(_documents(spark, sf_dir), ["doc_id"], pii.key_of(spark))
    return clean.select("row.doc_id", F.col("clean").alias("text"), *(f"n_{k}" for k in pii.KINDS))


def histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = sharding.shard(_documents(spark, sf_dir), ["doc_id", "text"])
    return moved.select(
        "row.doc_id",
        "size",
        F.crc32(F.col("row.text").cast("binary")).alias("text_crc32"),
        F.lit(sharding.LAW).alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_documents(spark, sf_dir), ["doc_id"]).select("row.*", "*").drop("row")


def simhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, sf_dir), ["doc_id"]).select("row.doc_id", "fingerprint", "component_id")


def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.encoded(_documents(spark, sf_dir), public_tokenizers.path(WORD_VOCABULARY))


def weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_documents(spark, sf_dir), ["doc_id"])
    return mixed.select(
        "row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken")
    )


def nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return ann.neighbours(embeddings, F.col("vec_id") % ann.QUERY_STEP == 0)


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(BYTE_VOCABULARY)
    coded = bpe.encode(_documents(spark, sf_dir), ["doc_id"], path, public_tokenizers.PATTERN, with_ids=False)
    return coded.select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(_documents(spark, sf_dir), ["doc_id"])
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("row.doc_id", *counts, "base_failed", "kept", "p_good")


def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    named = langid.identify(docs, ["doc_id"], langid.fit(docs))
    return named.select("row.doc_id", langid.held_out("row.doc_id").alias("held_out"), "lang_pred", "score")


def ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of what the formatted conversations say, read back from their text and loss spans."""
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    events = chat.events_of(conversations).unionByName(chat.events_of(inline(spark, "conv_id, turn, role, text", _CONTROL_TURNS)))
    return chat.digests(chat.formatted(events))


def prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.shared_prefixes(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


#: A conversation whose texts are control strings of the chat template.
_CONTROL_TURNS = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_pii_pseudonyms": pii_pseudonyms,
        "op2_histogram_shards": histogram_shards,
        "op3_license_scan": license_scan,
        "op4_simhash_classes": simhash_classes,
        "op5_token_files": token_files,
        "op6_weighted_mix": weighted_mix,
        "op7_nearest": nearest,
        "op8_byte_bpe": byte_bpe,
        "op9_quality_votes": quality_votes,
        "op10_language": language,
        "op11_ranked_search": ranked_search,
        "op12_chat_format": chat_format,
        "op13_prefix_trie": prefix_trie,
    }


# Weights 3, 1, 2, share 150 %, cap 2; hashes, levels and whole copies as the operator defines them.
_MIX_SQL = r"""
    WITH docs AS (
        SELECT doc_id, source,
               cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS bigint) AS size,
               cast('0x' || substr(md5(coalesce(cast(doc_id AS varchar), '') || ':' || coalesce(text, '')), 1, 15) AS bigint) AS h
        FROM documents),
    sources AS (SELECT source, cast(sum(size) AS bigint) AS source_size FROM docs GROUP BY source),
    weighed AS (
        SELECT *, [3.0::double, 1.0::double, 2.0::double][cast((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS int)] AS w,
               2.0::double * source_size AS cap FROM sources),
    levels AS (
        SELECT *, (1.5::double * sum(source_size) OVER () - coalesce(sum(cap) OVER (
                      ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                  / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
        FROM weighed),
    goals AS (SELECT source, source_size, least(cap, max(level) OVER () * w) AS target FROM levels),
    split AS (
        SELECT *, CASE WHEN source_size > 0 THEN cast(floor(target / source_size) AS bigint) ELSE 0 END AS copies FROM goals),
    ranked AS (
        SELECT d.*, s.source_size, s.target, s.copies, s.target - s.copies * s.source_size AS budget,
               sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
               sum(d.size) OVER (PARTITION BY d.source, d.h) AS tie
        FROM docs d JOIN split s ON d.source IS NOT DISTINCT FROM s.source)
    SELECT doc_id, size, source_size, target,
           cast(size * (copies + CASE WHEN upto <= budget OR 2 * upto - tie < 2 * budget THEN 1 ELSE 0 END) AS bigint) AS taken
    FROM ranked
"""

# All in whole numbers but the weights.
_SEARCH_SQL = r"""
    WITH docs AS (
        SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {word}) AS words
        FROM documents),
    sized AS (SELECT doc_id, words, cast(len(words) AS bigint) AS n, row_number() OVER () AS d FROM docs WHERE len(words) > 0),
    total AS (SELECT count(*) AS docs, cast(sum(n) AS bigint) AS words FROM sized),
    counted AS (SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(words) AS term FROM sized) GROUP BY d, term),
    weights AS (
        SELECT term, cast(floor(1000 * ln(cast(2 * max(docs) + 2 AS double) / cast(2 * count(*) + 1 AS double))) AS bigint) AS w
        FROM counted, total GROUP BY term),
    items AS (
        SELECT item_id, i, unnest(list_distinct(words)) AS term FROM (
            SELECT item_id, row_number() OVER () AS i,
                   regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {word}) AS words
            FROM benchmark)),
    scored AS (
        SELECT i, item_id, d, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // words_all)))) AS score
        FROM items JOIN weights USING (term) JOIN counted USING (term)
        JOIN (SELECT d, n, docs, total.words AS words_all FROM sized, total) USING (d)
        GROUP BY i, item_id, d)
    SELECT item_id, cast(rank AS int) AS rank, doc_id, cast(score AS bigint) AS score FROM (
        SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank
        FROM scored JOIN sized USING (d) WHERE score > 0) WHERE rank <= 10
""".replace("{word}", r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'")

# The marks of a turn beside role and text: <s>, </s>, a line feed and 15 or 17 or 2 or 17 characters by role.
_CHAT_SQL = r"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
    marked AS (
        SELECT *, length(text) + len(regexp_extract_all(text, {control})) + 8
                  + CASE role WHEN 'user' THEN 15 WHEN 'system' THEN 17 WHEN 'assistant' THEN 2
                         ELSE 17 + length(role) + len(regexp_extract_all(role, {control})) END AS chars
        FROM turns)
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
           cast(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS bigint) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           cast(sum(chars) AS bigint) AS formatted_chars
    FROM marked GROUP BY conv_id
""".replace("{control}", f"'{chat.CONTROL}'")

# A node is the joined digests of its turns. Each node adds to every beginning of its path.
_TRIE_SQL = r"""
    WITH numbered AS (
        SELECT conv_id AS c, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS said,
               length(coalesce(text, '')) AS chars,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
        FROM conversations WHERE conv_id IS NOT NULL),
    convs AS (
        SELECT c, xor(4294967295, list_reduce(
                   list_prepend(4294967295, list_transform(range(1, length(cast(c AS varchar)) + 1), lambda i: cast(ascii(substr(cast(c AS varchar), i, 1)) AS bigint))),
                   lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384)))) % 6 AS h
        FROM (SELECT DISTINCT c FROM numbered)),
    rebuilt AS (
        SELECT c, place, said, chars FROM numbered JOIN convs USING (c) WHERE place > h
        UNION ALL SELECT v.c, place, said, chars FROM convs v JOIN numbered n ON n.c = v.c - v.c % 100 AND n.place <= h),
    prefixes AS (
        SELECT c, row_number() OVER w AS depth, string_agg(said, '') OVER w AS path, chars FROM rebuilt
        WINDOW w AS (PARTITION BY c ORDER BY place ROWS UNBOUNDED PRECEDING)
        UNION ALL SELECT c, 0, '', 0 FROM convs),
    tops AS (SELECT c, max(depth) AS depth FROM prefixes GROUP BY c),
    ends AS (SELECT path, sha256(string_agg(cast(c AS varchar), ',' ORDER BY c)) AS digest FROM prefixes JOIN tops USING (c, depth) GROUP BY path),
    nodes AS (SELECT path, depth, min(c) AS conv_id, count(*) AS n_convs, max(chars) AS chars FROM prefixes GROUP BY path, depth),
    family AS (SELECT substr(path, 1, 32 * (depth - 1)) AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
    sums AS (
        SELECT substr(path, 1, 32 * d) AS path, sum((n IS NULL)::int) AS n_leaves, sum((n_convs - 1) * chars) AS saved
        FROM (SELECT nodes.*, n, unnest(range(0, depth + 1)) AS d FROM nodes LEFT JOIN family USING (path)) GROUP BY 1)
    SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(f.n, 0) AS n_children,
           cast(s.n_leaves AS bigint) AS n_leaves, cast(s.saved AS bigint) AS saved_tokens, coalesce(e.digest, sha256('')) AS ends_sha256
    FROM nodes n JOIN sums s ON s.path = n.path LEFT JOIN family f ON f.path = n.path LEFT JOIN ends e ON e.path = n.path
    LEFT JOIN nodes p ON n.depth > 0 AND p.path = substr(n.path, 1, 32 * (n.depth - 1))
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op6_weighted_mix": _MIX_SQL,
        "op11_ranked_search": _SEARCH_SQL,
        "op12_chat_format": _CHAT_SQL,
        "op13_prefix_trie": _TRIE_SQL,
    }
