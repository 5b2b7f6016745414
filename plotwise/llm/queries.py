"""The queries of this package: each operator over its whole table, with its result's digest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plotwise.llm.conversations import damaged, repair_conversations
from plotwise.llm.embeddings import near_vectors
from plotwise.llm.exact import exact_groups
from plotwise.llm.langid import identify_language
from plotwise.llm.licenses import LEAST, PHRASES, STEP, TEMPLATES, scan_licenses
from plotwise.llm.minhash import near_duplicates
from plotwise.llm.mixing import mix_sources
from plotwise.llm.packing import pack_documents
from plotwise.llm.phrases import collocations
from plotwise.llm.pii import KINDS as PII_KINDS, find_personal_data
from plotwise.llm.secrets import KINDS, find_secrets, said_spans
from plotwise.llm.spark import table
from plotwise.llm.substring import substring_dedup
from plotwise.llm.toxicity import score_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def _counts(spans: str, kinds) -> list[Column]:
    """n_<kind> of each kind. The function given to filter() takes one argument: a second is the place in the array."""
    return [
        F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long").alias(f"n_{name}") for k, name in enumerate(kinds)
    ]


SQL_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@query(
    "op1_substring_dedup",
    f"""
    WITH docs AS (SELECT doc_id, {SQL_WORDS} AS words FROM documents),
    starts AS (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS s FROM docs),
    windows AS (SELECT doc_id, s, md5(array_to_string(words[s:s + 19], ' ')) AS h FROM starts),
    ranked AS (SELECT doc_id, s, row_number() OVER (PARTITION BY h ORDER BY doc_id, s) AS nth FROM windows),
    placed AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM docs),
    covered AS (
      SELECT p.doc_id, p.word, p.i,
        max(r.s) OVER (PARTITION BY p.doc_id ORDER BY p.i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
      FROM placed p LEFT JOIN ranked r ON r.doc_id = p.doc_id AND r.s = p.i AND r.nth > 1),
    counted AS (
      SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
        sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
      FROM covered GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
      coalesce(kept_sha256, sha256('')) AS kept_sha256
    FROM docs d LEFT JOIN counted USING (doc_id)
    """,
)
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op2_secret_scan")
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < KINDS.index("random"))
    return found.select(
        "doc_id",
        *_counts("spans", KINDS[:3]),
        F.sha2(said_spans(base), 256).alias("base_sha256"),
        said_spans(F.col("spans")).alias("spans"),
    )


@query(
    "op4_source_mix",
    f"""
    WITH sized AS (SELECT doc_id, source, coalesce(len({SQL_WORDS}), 0)::BIGINT AS size FROM documents),
    weighted AS (
      SELECT source, sum(size)::BIGINT AS source_size, sum(size)::DOUBLE * 2 AS most,
        [5.0::DOUBLE, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
      FROM sized GROUP BY source),
    leveled AS (
      SELECT *, (sum(source_size) OVER ()::DOUBLE * 1.5
          - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST
                     ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM weighted),
    targets AS (
      SELECT source, source_size, CASE WHEN most <= level * weight THEN most
        ELSE max(CASE WHEN most <= level * weight THEN NULL ELSE level END) OVER () * weight END AS target
      FROM leveled),
    keyed AS (
      SELECT *, floor(log2(size + 1) * 16) AS class,
        floor(('0x' || substr(md5('7|' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0 * 256) AS bucket,
        ('0x' || substr(md5('7|offset|' || coalesce(source, '')), 1, 8))::BIGINT / 4294967296.0 AS u
      FROM sized),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY source ORDER BY class, bucket, size, doc_id NULLS LAST) AS n FROM keyed)
    SELECT r.doc_id, r.size, t.source_size, t.target, (r.size * (
        floor(n * (CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END) + u)
        - floor((n - 1) * (CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END) + u)))::BIGINT AS taken
    FROM ranked r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source
    """,
)
def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query(
    "op7_exact_dedup",
    """
    WITH docs AS (
      SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
      FROM documents)
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
      doc_id = max(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
    FROM docs WINDOW same AS (PARTITION BY norm)
    """,
)
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query(
    "op10_near_dedup",
    f"""
    WITH RECURSIVE docs AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
    places AS (
      SELECT doc_id, words, unnest(CASE WHEN len(words) >= 4 THEN range(1, len(words) - 2)
        WHEN len(words) > 0 THEN [1] ELSE [] END) AS s FROM docs),
    shingles AS (SELECT DISTINCT doc_id, md5(array_to_string(words[s:s + 3], ' ')) AS h FROM places),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    common AS (
      SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
      FROM shingles a JOIN shingles b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
    links AS (
      SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
      WHERE 100 * c >= 80 * (x.n + y.n - c)),
    reach AS (
      SELECT doc_id AS a, doc_id AS b FROM docs
      UNION SELECT r.a, l.b FROM reach r JOIN (SELECT a, b FROM links UNION ALL SELECT b, a FROM links) l ON l.a = r.b)
    SELECT d.doc_id, coalesce(n, 0) AS n_shingles, min(b) AS component_id, d.doc_id = min(b) AS kept
    FROM docs d JOIN reach ON a = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id GROUP BY d.doc_id, n
    """,
)
def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_language_id")
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_language(table(spark, sf_dir, "documents"))


@query("op6_personal_data")
def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"))
    names = F.array(*[F.lit(k) for k in PII_KINDS])

    def said(spans):
        one = F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        )
        return F.array_join(one, ",")

    counts = _counts("base", PII_KINDS)
    return found.select("doc_id", *counts, F.sha2(said("base"), 256).alias("base_sha256"), said("spans").alias("spans"))


@query(
    "op8_embedding_dedup",
    """
    WITH RECURSIVE vectors AS (
      SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links AS (
      SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b
        ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
      WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
    reach AS (
      SELECT vec_id AS a, vec_id AS b FROM embeddings
      UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
    degrees AS (SELECT a, count(*) AS n FROM links GROUP BY a)
    SELECT e.vec_id, coalesce(n, 0) AS n_links, min(b) AS component_id, e.vec_id = min(b) AS kept
    FROM embeddings e JOIN reach r ON r.a = e.vec_id LEFT JOIN degrees d ON d.a = e.vec_id GROUP BY e.vec_id, n
    """,
)
def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


@query("op9_best_fit_packing")
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


@query(
    "op11_conversation_repair",
    """
    WITH RECURSIVE keyed AS (
      SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
          lambda c: ascii(c)::BIGINT) AS bytes
      FROM conversations),
    drawn AS (
      SELECT *, xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda c, b:
        list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384::BIGINT * (x & 1))))) % 20 AS d
      FROM keyed),
    standing AS (
      SELECT conv_id, turn, CASE d WHEN 4 THEN 'user' ELSE role END AS role,
        CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(CASE d WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
      FROM drawn),
    placed AS (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
        substr(role, 1, 1) AS x, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last
      FROM standing),
    faulted AS (
      SELECT *, CASE WHEN last = '' THEN 'b'
          WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
          WHEN last NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
        lag(x) OVER (PARTITION BY conv_id ORDER BY i) || x NOT IN ('su', 'ua', 'au') AS illegal
      FROM placed),
    counted AS (
      SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
        count(*) FILTER (WHERE fault = 'b') AS blank, count(*) FILTER (WHERE fault = 'd') AS duplicate,
        count(*) FILTER (WHERE fault = 't') AS truncated, count(*) FILTER (WHERE illegal) AS illegal, count(*) AS n
      FROM faulted GROUP BY conv_id),
    grammar(p, x, q) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
    adds AS (SELECT p, q FROM grammar WHERE x <> 's'),
    inserts AS (
      SELECT p, p AS q, 0 AS c, '' AS e FROM (VALUES (0), (1), (2), (3)) s(p)
      UNION ALL SELECT p, q, 2, 'I' FROM adds
      UNION ALL SELECT a.p, b.q, 4, 'II' FROM adds a JOIN adds b ON a.q = b.p),
    edits AS (
      SELECT p, x, q, 'K' AS e, 0 AS c FROM grammar
      UNION ALL SELECT p, NULL, q, 'R', 2 FROM adds
      UNION ALL SELECT p, NULL, p, 'D', 3 FROM (VALUES (0), (1), (2), (3)) s(p)),
    ways AS (
      SELECT conv_id, 0::BIGINT AS i, 0 AS state, {'c': 0::BIGINT, 'e': ''} AS best FROM counted
      UNION ALL
      SELECT w.conv_id, f.i, e.q, min({'c': w.best.c + n.c + e.c + CASE WHEN f.fault = 't' AND e.e <> 'D' THEN 1 ELSE 0 END,
        'e': w.best.e || n.e || e.e})
      FROM ways w JOIN inserts n ON n.p = w.state JOIN faulted f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
        JOIN edits e ON e.p = n.q AND (e.e <> 'K' OR e.x = f.x) AND (e.e = 'D' OR f.fault NOT IN ('b', 'd'))
      GROUP BY w.conv_id, f.i, e.q),
    solved AS (
      SELECT w.conv_id, min({'c': w.best.c + n.c, 'e': w.best.e || n.e}) AS best
      FROM ways w JOIN counted k ON k.conv_id IS NOT DISTINCT FROM w.conv_id AND k.n = w.i JOIN inserts n ON n.p = w.state
      WHERE n.q IN (0, 3) GROUP BY w.conv_id),
    made AS (
      SELECT conv_id, pos, substr(best.e, pos, 1) AS e, pos - len(replace(substr(best.e, 1, pos), 'I', '')) AS skipped
      FROM (SELECT conv_id, best, unnest(range(1, len(best.e) + 1)) AS pos FROM solved)),
    told AS (
      SELECT m.conv_id, m.pos, m.e, f.role, CASE WHEN m.e = 'I' THEN '' ELSE f.text END AS text, f.x,
        row_number() OVER (PARTITION BY m.conv_id ORDER BY m.pos) AS o
      FROM made m LEFT JOIN faulted f ON f.conv_id IS NOT DISTINCT FROM m.conv_id AND f.i = m.pos - m.skipped AND m.e <> 'I'
      WHERE m.e <> 'D'),
    systems AS (SELECT conv_id, count(*) FILTER (WHERE o = 1 AND e = 'K' AND x = 's') AS s FROM told GROUP BY conv_id),
    hashed AS (
      SELECT t.conv_id, sha256(string_agg(CASE WHEN e = 'K' THEN role WHEN (o - s) % 2 = 1 THEN 'user' ELSE 'assistant' END
        || ':' || text, chr(10) ORDER BY o)) AS sha
      FROM told t JOIN systems y ON y.conv_id IS NOT DISTINCT FROM t.conv_id GROUP BY t.conv_id)
    SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
      coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost,
      coalesce(best.e, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) a
      LEFT JOIN counted k ON k.conv_id IS NOT DISTINCT FROM a.conv_id
      LEFT JOIN solved v ON v.conv_id IS NOT DISTINCT FROM a.conv_id
      LEFT JOIN hashed h ON h.conv_id IS NOT DISTINCT FROM a.conv_id
    """,
)
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, copies = damaged(table(spark, sf_dir, "conversations"))
    return repair_conversations(rows, copies=copies)


@query(
    "op12_collocations",
    """
    WITH pieces AS (
      SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
      FROM documents),
    spoken AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
    totals AS (SELECT lang, sum(len(words))::BIGINT AS n FROM spoken GROUP BY lang),
    grams AS (
      SELECT lang, unnest(list_transform(range(1, len(words) - size + 2), lambda i: words[i:i + size - 1])) AS g
      FROM spoken, (VALUES (1), (2), (3), (4)) s(size)),
    frequent AS (SELECT lang, g, count(*) AS f FROM grams GROUP BY lang, g HAVING count(*) >= 30),
    cuts AS (SELECT lang, g, f AS a, unnest(range(1, len(g))) AS k FROM frequent WHERE len(g) > 1),
    parted AS (
      SELECT c.lang, c.g, c.a, c.k, x.f AS l, y.f AS r, (2000000::HUGEINT * a // (x.f + y.f))::BIGINT AS score
      FROM cuts c JOIN frequent x ON x.lang = c.lang AND x.g = c.g[1:c.k]
        JOIN frequent y ON y.lang = c.lang AND y.g = c.g[c.k + 1:]),
    lowest AS (SELECT * FROM parted QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
    inner_phrases AS (
      SELECT lang, g[i:i + size - 1] AS g, max(f) AS most
      FROM (SELECT lang, g, f, size, unnest(range(1, len(g) - size + 2)) AS i
            FROM frequent, (VALUES (2), (3)) s(size) WHERE len(g) > size)
      GROUP BY ALL),
    ranked AS (
      SELECT c.lang, array_to_string(c.g, ' ') AS phrase, a, l, r, score,
        row_number() OVER (PARTITION BY c.lang ORDER BY score DESC, a DESC, array_to_string(c.g, ' ')) AS rank
      FROM lowest c LEFT JOIN inner_phrases i ON i.lang = c.lang AND i.g = c.g
      WHERE most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * a)
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
    """,
)
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def _listed(rows) -> str:
    return ", ".join(f"('{text}', '{label}')" for text, label in rows)


@query(
    "op13_license_scan",
    f"""
    WITH said AS (
      SELECT row_number() OVER () AS key, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
      FROM documents),
    phrases AS (SELECT string_split(p, ' ') AS p, label FROM (VALUES {_listed(PHRASES)}) v(p, label)),
    spots AS (
      SELECT key, label, unnest(list_filter(range(len(words) - len(p) + 1), lambda i: words[i + 1:i + len(p)] = p)) AS spot
      FROM said, phrases),
    base AS (
      SELECT key, count(*) AS n_base, min(spot) AS first_word, max(spot) AS last_word, list(DISTINCT label) AS labels
      FROM spots GROUP BY key),
    templates AS (
      SELECT list_distinct(string_split(t, ' ')) AS own, label
      FROM (VALUES {_listed((text, label) for label, text in TEMPLATES)}) v(t, label)),
    blocks AS (
      SELECT key, list_distinct(words[b * {STEP} + 1:b * {STEP} + {2 * STEP}]) AS tokens
      FROM (SELECT key, words, unnest(range(ceil(len(words) / {STEP})::BIGINT)) AS b FROM said)),
    shared AS (SELECT key, label, len(list_intersect(own, tokens)) / len(own) AS share FROM blocks, templates),
    found AS (
      SELECT key, list(DISTINCT label) AS labels, max(share) AS best FROM shared WHERE share >= {LEAST} GROUP BY key)
    SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
      array_to_string(list_sort(coalesce(b.labels, [])), ',') AS base_labels,
      array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(f.labels, [])))), ',') AS labels,
      CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0::DOUBLE) END AS score
    FROM said LEFT JOIN base b USING (key) LEFT JOIN found f USING (key)
    """,
)
def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
