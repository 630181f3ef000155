"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import save
from tessera.llm.embedding import embedding_dedup
from tessera.llm.exact_dedup import exact_dedup
from tessera.llm.hmm_lm import hmm_scores
from tessera.llm.merkle import folded, merkle_manifest, proof_digest, row_digest
from tessera.llm.mixing import mix
from tessera.llm.packing import pack_documents
from tessera.llm.quality import quality_scores
from tessera.llm.simhash import simhash_dedup
from tessera.llm.substring import substring_dedup
from tessera.llm.toolcalls import conversation_messages
from tessera.llm.toxicity import toxicity_scores
from tessera.llm.trie import forked, ordered_turns, prefix_trie
from tessera.llm.warc import new_folder, read_packages, resolve, write_packages

try:
    import public_tokenizers

    #: The tokenizer file of op10, where the package of public tokenizers is installed.
    TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
except ImportError:
    TOKENIZER = "/opt/tokenizers/word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(_table(spark, sf_dir, "documents")).drop("text_hash", "kept")


def op2_hmm_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm_scores(_table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_table(spark, sf_dir, "documents")).drop("text_hash")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(_table(spark, sf_dir, "documents"))


def op5_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_messages(_table(spark, sf_dir, "conversations"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(_table(spark, sf_dir, "embeddings"))


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents")).drop("text_hash")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), TOKENIZER)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest of documents by language, held against a copy in which n_chars of some rows is one too large."""
    docs = _table(spark, sf_dir, "documents")
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    copy = row_digest(*[F.col(c) + 1 if c == "n_chars" else F.col(c) for c in columns])
    touched = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull()
    found = merkle_manifest(docs, columns, "lang", claimed=F.when(touched, copy))
    out = found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), folded(F.coalesce("claimed", "leaf"), F.col("proof")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_warc_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes pages as WARC records in ZIP packages and reads every record back by its range."""
    path = new_folder(spark)
    write_packages(_table(spark, sf_dir, "pages"), path)
    return resolve(save(read_packages(spark, path, payloads=False), "warc-records"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of conversations that begin with up to eight turns of the one whose number is the next lower multiple of five."""
    numbered = ordered_turns(_table(spark, sf_dir, "conversations"))
    conv = F.col("conv")
    turns, conversations = forked(numbered, conv - conv % 5, (F.crc32(conv.cast("string").cast("binary")) % 9).cast("int"), 8)
    return prefix_trie(turns, conversations).withColumnRenamed("saved_bytes", "saved_tokens").drop("digest")


QUERIES = {
    "op1_simhash_dedup": op1_simhash_dedup,
    "op2_hmm_language_model": op2_hmm_language_model,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_tool_call_linking": op5_tool_call_linking,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_source_mix": op7_source_mix,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_toxicity": op9_toxicity,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_warc_packages": op12_warc_packages,
    "op13_prefix_trie": op13_prefix_trie,
}

#: CRC-32 of ASCII texts: the table t of one byte's remainders, and the remainder of a text in its terms.
CRC_TABLE = """
        crc AS (
            SELECT range AS i, 0 AS k, range AS c FROM range(256)
            UNION ALL
            SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc WHERE k < 8),
        crc_table AS (SELECT list(c ORDER BY i) AS t FROM crc WHERE k = 8)"""


def _crc32(text: str) -> str:
    bytes_ = f"list_transform(str_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))"
    return f"xor(list_reduce([4294967295] || {bytes_}, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


def _length_coded(*values: str) -> str:
    return " || ".join(f"coalesce(strlen(CAST({v} AS VARCHAR)) || ':' || CAST({v} AS VARCHAR), '-')" for v in values)


ORACLE_SQL = {
    "op3_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER w AS keep_id,
               count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW w AS (PARTITION BY coalesce(text, ''))
    """,
    "op4_substring_dedup": """
        WITH w AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS a FROM documents),
        win AS (
            SELECT doc_id, s, list_aggregate(a[s:s + 19], 'string_agg', ' ') AS k
            FROM (SELECT doc_id, a, unnest(range(1, len(a) - 18)) AS s FROM w WHERE len(a) >= 20)),
        later AS (
            SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS r FROM win) WHERE r > 1),
        gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM later),
        words AS (SELECT doc_id, unnest(a) AS word, unnest(range(1, len(a) + 1)) AS p FROM w),
        cut AS (
            SELECT w.doc_id, count(*) FILTER (g.p IS NOT NULL) AS n_removed,
                   string_agg(w.word, ' ' ORDER BY w.p) FILTER (g.p IS NULL) AS kept
            FROM words w LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.p = w.p GROUP BY w.doc_id)
        SELECT w.doc_id, CAST(len(w.a) AS BIGINT) AS n_words, coalesce(c.n_removed, 0) AS n_removed,
               sha256(coalesce(c.kept, '')) AS kept_sha256
        FROM w LEFT JOIN cut c ON c.doc_id = w.doc_id
    """,
    "op5_tool_call_linking": """
        WITH RECURSIVE each AS (
            SELECT conv_id, turn, role, text, count(*) AS copies, CASE role WHEN 'user' THEN 1 WHEN 'assistant' THEN 2 ELSE 0 END AS rank
            FROM conversations GROUP BY conv_id, turn, role, text),
        placed AS (
            SELECT *, row_number() OVER w - 1 AS pos, count(*) FILTER (rank = 1) OVER w AS asked
            FROM each WHERE conv_id IS NOT NULL
            WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, rank, role NULLS FIRST, coalesce(sha256(text), '') ROWS UNBOUNDED PRECEDING)),
        calls AS (
            SELECT *, conv_id || ':' || asked AS call_id, CASE WHEN asked > 1 THEN conv_id || ':' || (asked - 1) END AS after FROM placed WHERE rank = 1),
        answers AS (
            SELECT *, conv_id || ':' || asked AS call_id, row_number() OVER (PARTITION BY conv_id, asked ORDER BY pos) AS r FROM placed WHERE rank = 2),
        depths AS (
            SELECT call_id, CAST(0 AS BIGINT) AS depth FROM calls WHERE after IS NULL
            UNION ALL
            SELECT c.call_id, d.depth + 1 FROM calls c JOIN depths d ON c.after = d.call_id),
        linked AS (
            SELECT coalesce(c.call_id, a.call_id) AS call_id, coalesce(c.conv_id, a.conv_id) AS conv_id,
                   CASE WHEN a.r > 1 THEN 'repeated result' WHEN c.call_id IS NULL THEN 'orphan' WHEN a.call_id IS NULL THEN 'unanswered' ELSE 'answered' END AS status,
                   c.call_id IS NOT NULL AS called, c.turn, c.text, c.after, coalesce(c.copies, 0) AS calls, coalesce(a.copies, 0) AS results, a.text AS content
            FROM calls c FULL JOIN answers a ON c.call_id = a.call_id AND a.r = 1)
        SELECT l.call_id, l.conv_id, l.status, d.depth, l.called AND l.text IS NOT NULL AS valid,
               CASE WHEN l.called AND l.text IS NULL THEN 'text: required' ELSE '' END AS errors, l.calls, l.results, 0 AS contexts,
               '{"arguments":' || CASE WHEN l.called THEN '{' || concat_ws(',', '"after":' || to_json(l.after), '"text":' || to_json(l.text), '"turn":' || l.turn) || '}' ELSE 'null' END
                   || ',"id":' || to_json(l.call_id) || ',"name":' || CASE WHEN l.called THEN '"reply"' ELSE 'null' END
                   || ',"result":' || CASE WHEN l.content IS NULL THEN 'null' ELSE to_json(l.content) END || '}' AS message
        FROM linked l LEFT JOIN depths d ON d.call_id = l.call_id AND l.called
        UNION ALL
        SELECT id, conv_id, 'context', NULL, true, '', 0, 0, copies,
               '{"content":' || CASE WHEN text IS NULL THEN 'null' ELSE to_json(text) END || ',"id":' || CASE WHEN id IS NULL THEN 'null' ELSE to_json(id) END
                   || ',"role":' || CASE WHEN role IS NULL THEN 'null' ELSE to_json(role) END || ',"turn":' || coalesce(CAST(turn AS VARCHAR), 'null') || '}'
        FROM (SELECT conv_id, turn, role, text, copies, conv_id || ':context:' || pos AS id FROM placed WHERE rank = 0
              UNION ALL SELECT conv_id, turn, role, text, copies, NULL FROM each WHERE conv_id IS NULL)
    """,
    "op6_embedding_dedup": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
        good AS (
            SELECT * FROM v
            WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(e, lambda x: x <> 0)) > 0),
        links AS (
            SELECT a.vec_id AS u, b.vec_id AS v
            FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
            WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
        reach AS (
            SELECT vec_id AS u, vec_id AS v FROM v
            UNION
            SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u),
        low AS (SELECT u AS vec_id, min(v) AS component_id FROM reach GROUP BY u),
        n AS (SELECT u AS vec_id, count(*) AS n_links FROM links GROUP BY u)
        SELECT v.vec_id, coalesce(n.n_links, 0) AS n_links, low.component_id, v.vec_id = low.component_id AS kept
        FROM v JOIN low USING (vec_id) LEFT JOIN n USING (vec_id)
    """,
    "op7_source_mix": """
        WITH sized AS (
            SELECT doc_id, source, md5('mix' || coalesce(CAST(doc_id AS VARCHAR), '')) AS at,
                   CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
            FROM documents),
        per AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT) + 1] AS weight
            FROM sized GROUP BY source),
        -- the level of the water: with c sources capped, (total - their caps) / (weights of the others)
        levels AS (
            SELECT max((t.total - p.capped) / p.rest) AS level
            FROM (SELECT coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
                         sum(weight) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST
                              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM per) p,
                 (SELECT sum(source_size) AS total FROM per) t),
        targets AS (
            SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), level * weight) AS target,
                   CAST(floor(least(CAST(3 * source_size AS DOUBLE), level * weight) + 0.5) AS BIGINT) AS quota
            FROM per, levels),
        need AS (
            SELECT *, sum(n) OVER (ORDER BY s ROWS UNBOUNDED PRECEDING) - n AS low, sum(n) OVER () AS total
            FROM (SELECT *, passes * blocks + m AS n
                  FROM (SELECT source, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS s, source_size,
                               quota // source_size AS passes, quota % source_size AS rest,
                               (source_size + 1023) // 1024 AS blocks, (quota % source_size + 1023) // 1024 AS m
                        FROM targets WHERE quota > 0))),
        points AS (
            SELECT k, ((k % 2147483648 * 1327217885 + k // 2147483648 * 1607638789) % 2147483648) / 2147483648.0::DOUBLE AS x
            FROM (SELECT unnest(range((SELECT CAST(3 * sum(n) + 1 AS BIGINT) FROM need))) AS k)),
        dealt AS (
            SELECT s, k AS slot, (x - p) / (q - p) AS y, row_number() OVER (PARTITION BY s ORDER BY k) - 1 AS rank
            FROM points JOIN (SELECT s, low / total::DOUBLE AS p, (low + n) / total::DOUBLE AS q, total FROM need) r
              ON k < total AND x >= p AND x < q),
        short AS (
            SELECT *, sum(n) OVER (ORDER BY s ROWS UNBOUNDED PRECEDING) - n AS after
            FROM (SELECT need.s, n, total, count(slot) AS got FROM need LEFT JOIN dealt USING (s) GROUP BY ALL) WHERE got < n),
        more AS (
            SELECT s, slot, x AS y, rank
            FROM (SELECT s, total + after + rank AS slot, rank FROM (SELECT *, unnest(range(got, CAST(n AS BIGINT))) AS rank FROM short)) m
            JOIN points ON points.k = m.slot),
        taking AS (
            SELECT s, slot, y, rank, rank % blocks AS block, CASE WHEN m > 0 AND rank = n - 1 THEN rest - (m - 1) * 1024 END AS part
            FROM (SELECT * FROM dealt UNION ALL SELECT s, slot, y, rank FROM more) JOIN need USING (s) WHERE rank < n),
        placed AS (
            SELECT d.*, t.source_size, t.target, n.s, n.blocks * n.total::DOUBLE / n.n AS pass_slots,
                   CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.at, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size AS BIGINT) AS start
            FROM (SELECT *, row_number() OVER () AS row FROM sized) d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
            LEFT JOIN need n ON d.source IS NOT DISTINCT FROM n.source),
        turned AS (
            SELECT p.s, max(p.start) AS turn FROM placed p JOIN taking t ON t.s = p.s AND t.rank = 0
            WHERE p.size > 0 AND p.start <= t.y * p.source_size GROUP BY p.s),
        laid AS (
            SELECT p.* REPLACE (CASE WHEN p.size > 0 AND u.turn IS NOT NULL THEN (p.start - u.turn + p.source_size) % p.source_size ELSE p.start END AS start)
            FROM placed p LEFT JOIN turned u ON u.s = p.s),
        words AS (
            SELECT l.row, t.slot,
                   greatest(0, least(start + size - block * 1024, coalesce(part, 1024)) - greatest(start - block * 1024, 0)) AS w
            FROM laid l JOIN taking t ON l.s = t.s AND l.size > 0 AND t.block BETWEEN l.start // 1024 AND (l.start + l.size - 1) // 1024)
        SELECT l.doc_id, l.size, l.source_size, l.target, CAST(coalesce(sum(w.w), 0) AS BIGINT) AS taken,
               CAST(min(w.slot) FILTER (w.w > 0) AS BIGINT) AS first_slot,
               max(CASE WHEN w.w IS NOT NULL THEN l.pass_slots END) AS pass_slots
        FROM laid l LEFT JOIN words w USING (row)
        GROUP BY l.row, l.doc_id, l.size, l.source_size, l.target
    """,
    "op11_merkle_manifest": f"""
        WITH RECURSIVE {CRC_TABLE},
        rows AS (
            SELECT doc_id, coalesce('=' || lang, '-') AS k, sha256({_length_coded("doc_id", "source", "lang", "n_chars", "text")}) AS leaf,
                   CASE WHEN n_chars IS NOT NULL AND {_crc32("CAST(doc_id AS VARCHAR)")} % 7 = 0
                        THEN sha256({_length_coded("doc_id", "source", "lang", "n_chars + 1", "text")}) END AS claimed
            FROM documents, crc_table),
        leaves AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM rows),
        trees AS (
            SELECT k, 0 AS l, list(leaf ORDER BY i) AS a FROM leaves GROUP BY k
            UNION ALL
            SELECT k, l + 1, list_transform(range(0, len(a), 2), lambda j: sha256(a[j + 1] || coalesce(a[j + 2], ''))) FROM trees WHERE len(a) > 1),
        subroots AS (SELECT k, a[1] AS subroot, row_number() OVER (ORDER BY k) - 1 AS i FROM trees WHERE len(a) = 1),
        crown AS (
            SELECT 0 AS l, list(subroot ORDER BY i) AS a FROM subroots HAVING count(*) > 0
            UNION ALL
            SELECT l + 1, list_transform(range(0, len(a), 2), lambda j: sha256(a[j + 1] || coalesce(a[j + 2], ''))) FROM crown WHERE len(a) > 1),
        upper AS (
            SELECT k, subroot, coalesce(list(CASE WHEN s IS NULL THEN '-' WHEN (i >> l) & 1 = 1 THEN 'L' || s ELSE 'R' || s END ORDER BY l) FILTER (l IS NOT NULL), []) AS steps
            FROM (SELECT k, subroot, i, l, a[CAST(xor(i >> l, 1) AS BIGINT) + 1] AS s FROM subroots LEFT JOIN crown ON len(a) > 1) GROUP BY k, subroot),
        proofs AS (
            SELECT k, i, coalesce(list(CASE WHEN s IS NULL THEN '-' WHEN (i >> l) & 1 = 1 THEN 'L' || s ELSE 'R' || s END ORDER BY l) FILTER (l IS NOT NULL), []) AS steps
            FROM (SELECT x.k, i, l, a[CAST(xor(i >> l, 1) AS BIGINT) + 1] AS s FROM leaves x LEFT JOIN trees t ON t.k = x.k AND len(a) > 1) GROUP BY k, i),
        every AS (
            SELECT doc_id, leaf, subroot, (SELECT a[1] FROM crown WHERE len(a) = 1) AS root, coalesce(claimed, leaf) AS start, p.steps || u.steps AS steps
            FROM leaves x JOIN proofs p ON p.k = x.k AND p.i = x.i JOIN upper u ON u.k = x.k),
        done AS (
            SELECT *, sha256(array_to_string(list_transform(list_filter(steps, lambda s: s <> '-'), lambda s: s[2:]), '')) AS proof_sha256,
                   list_reduce([start] || steps, lambda d, s: sha256(CASE s[1] WHEN 'L' THEN s[2:] || d WHEN 'R' THEN d || s[2:] ELSE d END)) AS folded_root
            FROM every)
        SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM done
    """,
    "op12_warc_packages": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
        d AS (
            SELECT *, sha1(payload) AS hex, max(page_id) OVER (PARTITION BY payload) AS latest, count(*) OVER (PARTITION BY payload) AS n FROM p),
        digits AS (SELECT *, list_transform(range(8), lambda i: CAST('0x' || hex[i * 5 + 1:i * 5 + 5] AS BIGINT)) AS five FROM d)
        SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes,
               array_to_string(list_transform(five, lambda v: array_to_string(list_transform([15, 10, 5, 0],
                   lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((v >> k) & 31 AS BIGINT) + 1, 1)), '')), '') AS payload_digest,
               CASE WHEN page_id IS DISTINCT FROM latest THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id IS DISTINCT FROM latest THEN latest END AS refers_to
        FROM digits
    """,
    "op13_prefix_trie": f"""
        WITH RECURSIVE {CRC_TABLE},
        convs AS (
            SELECT conv_id AS c, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''),
                sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS turns
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
        heads AS (SELECT c, turns, {_crc32("CAST(c AS VARCHAR)")} % 9 AS h FROM convs, crc_table),
        rebuilt AS (
            SELECT x.c, coalesce(b.turns[1:x.h], []) || x.turns[x.h + 1:] AS turns FROM heads x LEFT JOIN convs b ON b.c = x.c - x.c % 5),
        paths AS (SELECT c, len(turns) AS n, d, turns[1:d] AS prefix FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)),
        nodes AS (
            SELECT prefix, d, min(c) AS conv_id, count(*) AS n_convs, list(c ORDER BY c) FILTER (n = d) AS ends FROM paths GROUP BY prefix, d),
        linked AS (SELECT x.*, p.conv_id AS parent FROM nodes x LEFT JOIN nodes p ON x.d > 0 AND p.d = x.d - 1 AND p.prefix = x.prefix[1:x.d - 1]),
        children AS (SELECT prefix[1:d - 1] AS prefix, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1, 2),
        full_nodes AS (
            SELECT x.*, coalesce(k.n, 0) AS n_children, CASE WHEN x.d > 0 THEN (n_convs - 1) * strlen(x.prefix[x.d].t) ELSE 0 END AS saved
            FROM linked x LEFT JOIN children k ON k.d = x.d AND k.prefix = x.prefix),
        sums AS (
            SELECT a.prefix, a.d, count(*) FILTER (b.n_children = 0) AS n_leaves, sum(b.saved) AS saved
            FROM (SELECT prefix[1:k] AS prefix, k AS d, n_children, saved FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM full_nodes)) b
            JOIN nodes a ON a.d = b.d AND a.prefix = b.prefix GROUP BY a.prefix, a.d)
        SELECT x.conv_id, CAST(x.d AS BIGINT) AS depth, x.parent AS parent_conv_id, x.n_convs, x.n_children, s.n_leaves,
               CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(array_to_string(x.ends, ','), '')) AS ends_sha256
        FROM full_nodes x JOIN sums s ON s.d = x.d AND s.prefix = x.prefix
    """,
}
