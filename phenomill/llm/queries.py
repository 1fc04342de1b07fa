"""The numbered queries over whole tables, and their SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from phenomill.llm import (
    bpe,
    chat_windows,
    exact_index,
    jaccard_links,
    kneser_ney,
    near_dup_vectors,
    packing,
    phrase_automata,
    phrase_mining,
    prefix_trie,
    quality_mil,
    secret_scan,
    warc,
)
from phenomill.llm.common import table

RANKS = "byte_bpe_50k.tiktoken"
VOCABULARY = "byte_bpe_50k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register


@query(
    """
    WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings),
    l AS (
        SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
        WHERE list_cosine_similarity(a.x, b.x) >= 0.93
    ),
    n AS (SELECT a, count(*) AS n FROM l GROUP BY a),
    r(node, seen) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.node, l.b FROM r JOIN l ON l.a = r.seen)
    SELECT vec_id, coalesce(any_value(n), 0) AS n_links, min(seen) AS component_id, min(seen) = vec_id AS kept
    FROM v LEFT JOIN n ON n.a = vec_id JOIN r ON r.node = vec_id GROUP BY vec_id
    """
)
def op1_vector_codes(spark, folder):
    return near_dup_vectors.near_duplicates(table(spark, folder, "embeddings"))


@query()
def op2_chat_windows(spark, folder):
    probe = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat_windows.read_back(chat_windows.windows(turns, public_tokenizers.path(RANKS), public_tokenizers.PATTERN))


@query()
def op3_secret_scan(spark, folder):
    return secret_scan.digest_columns(secret_scan.scan(table(spark, folder, "documents"), public_tokenizers.path(RANKS)))


@query()
def op4_quality_mil(spark, folder):
    docs = table(spark, folder, "documents")
    return quality_mil.scores(docs, quality_mil.fit(docs, table(spark, folder, "labels")))


@query(
    r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (SELECT doc_id, unnest(range(1, len(w) - 48)) AS i, w FROM d WHERE len(w) >= 50),
    k AS (SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 49), ' ')) AS h FROM s),
    f AS (SELECT h, min(doc_id) AS first FROM k GROUP BY h),
    g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM k JOIN f USING (h) WHERE first < doc_id),
    g2 AS (SELECT doc_id, list(i) AS gone FROM g GROUP BY doc_id),
    r AS (
        SELECT doc_id, w, coalesce(gone, []) AS gone FROM d LEFT JOIN g2 USING (doc_id)
    ),
    p AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
    t AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM p ANTI JOIN g USING (doc_id, i) GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, len(gone) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM r LEFT JOIN t USING (doc_id)
    """
)
def op5_phrase_automata(spark, folder):
    return phrase_automata.remove_repeats(table(spark, folder, "documents"))


@query(
    """
    WITH d AS (
        SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h FROM documents
    )
    SELECT doc_id, max(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
           doc_id = max(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
    FROM d
    """
)
def op6_exact_dedup(spark, folder):
    return exact_index.exact_groups(table(spark, folder, "documents"))


@query()
def op7_byte_bpe(spark, folder):
    return bpe.round_trip(table(spark, folder, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


@query(
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
    s AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS stays FROM p)
    SELECT page_id, octet_length(encode(html)) AS payload_bytes,
           array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               1 + ((('0x' || substr(h, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT, 1)), '') AS payload_digest,
           CASE WHEN page_id = stays THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> stays THEN stays END AS refers_to
    FROM s
    """
)
def op8_warc(spark, folder):
    rows = warc.archived_pages(table(spark, folder, "pages"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op9_packing(spark, folder):
    return packing.packed_documents(table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


@query(
    r"""
    WITH RECURSIVE d AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x20\x09-\x0D]+') AS w
        FROM documents
    ),
    s AS (
        SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) AS g
        FROM d WHERE len(w) > 0
    ),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
    l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
    e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
    r(node, seen) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.seen)
    SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.seen) AS component_id
    FROM d LEFT JOIN n USING (doc_id) JOIN r ON r.node = d.doc_id GROUP BY d.doc_id
    """
)
def op10_jaccard_join(spark, folder):
    """The complete join in the columns that the SQL has."""
    return op10_jaccard_links(spark, folder).drop("n_links")


@query()
def op10_jaccard_links(spark, folder):
    """The same join with the number of links of each document."""
    return jaccard_links.linked_documents(table(spark, folder, "documents"))


CRC32 = """list_reduce(
    list_concat([4294967295::BIGINT], flatten(list_transform(string_split({0}::VARCHAR, ''), lambda c: list_concat([ascii(c)::BIGINT], repeat([-1::BIGINT], 8))))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END)"""


def crc32(column: str) -> str:
    """SQL for the unsigned crc32 of a number's digits."""
    return f"xor({CRC32.format(column)}, 4294967295)"


@query(
    f"""
    WITH t AS (
        SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos,
               {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS said
        FROM conversations WHERE conv_id IS NOT NULL
    ),
    c AS (SELECT conv_id, list(said ORDER BY pos) AS own, ({crc32('conv_id')} % 6)::INT AS h FROM t GROUP BY conv_id),
    r AS (
        SELECT c.conv_id, list_concat(coalesce(d.own, [])[:c.h], c.own[c.h + 1:]) AS said
        FROM c LEFT JOIN c d ON d.conv_id = c.conv_id - c.conv_id % 100
    ),
    p AS (SELECT conv_id, len(said) AS ends, unnest(range(0, len(said) + 1)) AS depth, said FROM r),
    k AS (
        SELECT conv_id, ends, depth, sha256(said[:depth]::JSON::VARCHAR) AS node,
               CASE WHEN depth > 0 THEN length(said[depth].text) ELSE 0 END AS size,
               list_transform(range(0, depth + 1), lambda i: sha256(said[:i]::JSON::VARCHAR)) AS path
        FROM p
    ),
    n AS (
        SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(path) AS path, (count(*) - 1) * any_value(size) AS saved,
               sha256(coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (ends = depth), '')) AS ends_sha256
        FROM k GROUP BY node, depth
    ),
    kids AS (SELECT path[-2] AS node, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
    below AS (
        SELECT u.node, count(*) FILTER (kids.node IS NULL) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
        FROM (SELECT node AS leaf, saved, unnest(path) AS node FROM n) u LEFT JOIN kids ON kids.node = u.leaf GROUP BY u.node
    )
    SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256
    FROM n JOIN below USING (node) LEFT JOIN kids USING (node) LEFT JOIN n up ON n.depth > 0 AND up.node = n.path[-2]
    """
)
def op11_prefix_trie(spark, folder):
    """One row per distinct prefix of the rebuilt conversations."""
    return prefix_trie.conversation_trie(table(spark, folder, "conversations"))


@query()
def op12_kneser_ney(spark, folder):
    """Log10 probabilities of all documents under the model of the four folds that are not held out."""
    return kneser_ney.held_out_scores(table(spark, folder, "documents"))


@query(
    r"""
    WITH d AS (
        SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc,
               regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\f\r]') AS pieces
        FROM documents
    ),
    p AS (SELECT lang, regexp_extract_all(unnest(pieces), '[^ \t]+') AS w FROM d),
    g AS (
        SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase
        FROM (SELECT lang, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM p, (VALUES (1), (2), (3)) AS s(k) WHERE len(w) >= k)
    ),
    f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL),
    n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
    c AS MATERIALIZED (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= 10),
    h AS MATERIALIZED (
        SELECT lang, phrase, a, cut, array_to_string(w[:cut], ' ') AS head, array_to_string(w[cut + 1:], ' ') AS tail
        FROM (SELECT *, unnest(range(1, k)) AS cut FROM c)
    ),
    s AS (
        SELECT h.lang, h.phrase, h.a, cut, x.a AS l, y.a AS r, ((1000000 * h.a::HUGEINT * h.a) // (x.a::HUGEINT * y.a))::BIGINT AS score
        FROM h JOIN f x ON x.lang = h.lang AND x.phrase = head JOIN f y ON y.lang = h.lang AND y.phrase = tail
    ),
    b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
    i AS (
        SELECT lang, phrase, max(a) AS longer FROM (
            SELECT lang, a, array_to_string(w[:2], ' ') AS phrase FROM c WHERE k = 3 UNION ALL SELECT lang, a, array_to_string(w[2:], ' ') FROM c WHERE k = 3
        ) GROUP BY ALL
    ),
    kept AS (SELECT b.* FROM b LEFT JOIN i USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
    FROM kept JOIN n USING (lang) QUALIFY rank <= 2000
    """
)
def op13_phrase_mining(spark, folder):
    """The 2,000 strongest phrases of two and three words of each language."""
    return phrase_mining.collocations(table(spark, folder, "documents"))
