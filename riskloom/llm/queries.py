"""The text operators over the given tables, and their SQL."""

import re

from pyspark.sql import functions as F

from riskloom.llm import (centroids, decontam, linefreq, packing, preference, quality, rans, secretscan, setjoin, suffix,
                          surrogate, tokens, warc, whitening)
from riskloom.session import materialize

# Whoever keeps the key can link a surrogate to its entity; a deployment passes its own.
SURROGATE_KEY = "synthetic tables"
BYTE_VOCABULARY, WORD_VOCABULARY = "byte_bpe_50k.json", "word_bpe_49k.json"


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def host_quality(spark, sf_dir):
    """Signals and verdict of every document."""
    return quality.judge_documents(_table(spark, sf_dir, "documents"), ["doc_id"])


def suffix_dedup(spark, sf_dir):
    """Every document without the strings that earlier documents hold."""
    return suffix.remove_repeats(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def best_fit_packing(spark, sf_dir):
    """Pieces of every document and where they stand."""
    pieces = packing.pack_documents(_table(spark, sf_dir, "documents"), tokens.vocabulary(BYTE_VOCABULARY))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def ngram_join(spark, sf_dir):
    """Every document's component of near duplicates."""
    return setjoin.near_duplicates(_table(spark, sf_dir, "documents")).drop("key", "label")


def surrogates(spark, sf_dir):
    """Every document with surrogates for its personal data."""
    return surrogate.replace_personal_data(_table(spark, sf_dir, "documents"), SURROGATE_KEY).select(
        "doc_id", "text", "n_entities")


def decontamination(spark, sf_dir):
    """Every document with the benchmark items that leak into it."""
    return decontam.mark_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), ["doc_id"])


def _spans_as_text(pairs):
    for name in ("chosen_spans", "rejected_spans"):
        text = F.array_join(F.transform(name, lambda s: F.concat_ws("-", s["start"].cast(
            "string"), s["end"].cast("string"))), ",")
        pairs = pairs.withColumn(name, text)
    return pairs


def preferences(spark, sf_dir):
    """Every conversation against itself with the next one's answer; spans as text, ``start-end`` each."""
    convs = materialize(preference.conversations(_table(spark, sf_dir, "conversations")), "conversations")
    return _spans_as_text(preference.format_sides(preference.answer_pairs(convs)))


def opening_preferences(spark, sf_dir):
    """Preference pairs of conversations with one opening turn, and the conversations left without a counterpart."""
    convs = materialize(preference.conversations(_table(spark, sf_dir, "conversations")), "conversations")
    pairs = materialize(preference.opening_pairs(convs), "pairs")
    return _spans_as_text(preference.format_preferences(convs, pairs).unionByName(
        preference.format_single(preference.unpaired(convs, pairs))))


def rans_tokens(spark, sf_dir):
    """Every document's tokens, written to coded files and read back."""
    folder = rans.write_tokens(_table(spark, sf_dir, "documents"), tokens.vocabulary(WORD_VOCABULARY), True)
    return rans.read_tokens(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def warc_salvage(spark, sf_dir):
    """Every page, written to archives and read back."""
    archives = warc.write_archives(_table(spark, sf_dir, "pages"))
    return warc.read_archives(archives, payloads=False).where("kind = 'record'").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def site_lines(spark, sf_dir):
    """Every document without its site's boilerplate lines."""
    return linefreq.drop_boilerplate(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", "text")


def embedding_whitening(spark, sf_dir):
    """Every vector's whitened components."""
    return whitening.whiten(_table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("bigint"))


def centroid_clusters(spark, sf_dir):
    """Every vector's cluster."""
    return centroids.cluster(_table(spark, sf_dir, "embeddings"))


def secret_scan(spark, sf_dir):
    """Every document's secrets."""
    def count(kind):
        return F.size(F.filter("secrets", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    found = secretscan.find_secrets(_table(spark, sf_dir, "documents"), ["doc_id"])
    base = [rule.kind for rule in secretscan.BASE]
    return found.select("doc_id", *map(count, base), F.sha2(secretscan.as_text(F.filter(
        "secrets", lambda x: x["kind"].isin(base))), 256).alias("base_sha256"), secretscan.as_text("secrets").alias("spans"))


QUERIES = {
    "op1_host_quality": host_quality,
    "op2_suffix_dedup": suffix_dedup,
    "op3_best_fit_packing": best_fit_packing,
    "op5_ngram_join": ngram_join,
    "op4_surrogates": surrogates,
    "op6_decontamination": decontamination,
    "op7_preferences": preferences,
    "op7_opening_preferences": opening_preferences,
    "op8_rans_tokens": rans_tokens,
    "op9_warc_salvage": warc_salvage,
    "op10_site_lines": site_lines,
    "op11_whitening": embedding_whitening,
    "op12_centroid_clusters": centroid_clusters,
    "op13_secret_scan": secret_scan,
}

_WORD = r"[^\x20\x09-\x0D]+"



def _rendered(turns):
    return (f"coalesce(array_to_string(list_transform({turns}, lambda x: '<|' || x.role || '|>' || chr(10) || x.text"
            f" || '<|end|>' || chr(10)), ''), '')")


def _span_text(turns):
    """Each assistant turn's place: after it lie its text and an end mark of 8 characters, before that a head of 5 and the role."""
    end = (f"CAST(list_sum(list_transform({turns}[1:i], lambda y: length(y.role) + length(y.text) + 13)) AS BIGINT)")
    return (f"coalesce(array_to_string(list_transform(list_filter(range(1, len({turns}) + 1), lambda i: {turns}[i].role = 'assistant'),"
            f" lambda i: ({end} - length({turns}[i].text) - 8) || '-' || {end}), ','), '')")


def _cluster_sql(k=40, rounds=5):
    """Every round as its own tables: numbered centroids, their distances to all vectors, the nearest ones, floored means."""
    def nearest(i):
        return f"""d{i} AS (SELECT v.vec_id, v.x, c.n, list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
    FROM v, c{i} c),
a{i} AS (SELECT vec_id, any_value(x) AS x, min(struct_pack(d := d, n := n)) AS m FROM d{i} GROUP BY vec_id),"""

    def means(i):
        return f"""s{i} AS (SELECT m.n AS n, i, CAST(floor(CAST(sum(x[i]) AS DECIMAL(38, 9)) / count(*)) AS BIGINT) AS x
    FROM a{i}, range(1, 65) r(i) GROUP BY m.n, i),
c{i + 1} AS (SELECT c.n, coalesce(s.x, c.x) AS x FROM c{i} c LEFT JOIN
    (SELECT n, list(x ORDER BY i) AS x FROM s{i} GROUP BY n) s USING (n)),"""

    steps = "\n".join(nearest(i) + "\n" + means(i) for i in range(rounds)) + "\n" + nearest(rounds)
    return f"""
WITH v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: isfinite(e))) = 64),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS n, x FROM v ORDER BY n LIMIT {k}),
{steps}
f AS (SELECT vec_id, CAST(m.n AS INTEGER) AS cluster, CAST(m.d AS BIGINT) AS distance FROM a{rounds})
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM f JOIN c{rounds} c ON c.n = f.cluster"""


def _secrets_sql():
    """Every rule as the texts between its matches, whose lengths add up to the matches' places; case by letter classes."""
    def either_case(pattern):
        return re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", pattern)

    word = "(" + either_case("password|passwd|secret|token|api_?key") + ")"
    rules = [("assign", word + r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
             ("access", "AKIA[A-Z0-9]+", 0, 18), ("hex", "[0-9a-f]+", 0, 16),
             *((r.kind, r.pattern, 0, 1) for r in secretscan.RULES[3:])]
    found = "\nUNION ALL ".join(
        f"SELECT rid, {n} AS rule, unnest(string_split_regex(text, '{p}')) AS piece, unnest(regexp_extract_all(text, '{p}')) AS whole,"
        f" unnest(regexp_extract_all(text, '{p}', {g})) AS value, {least} AS least,"
        f" unnest(range(1, len(string_split_regex(text, '{p}')) + 1)) AS i FROM t"
        for n, (_, p, g, least) in enumerate(rules))
    names = ", ".join(f"'{r[0]}'" for r in rules)
    joined = "coalesce(string_agg(([{0}])[rule + 1] || ':' || s || ':' || e, ',' ORDER BY s, rule){1}, '')"
    base = joined.format(names, " FILTER (WHERE rule < 3)")
    return f"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
m AS ({found}),
p AS (SELECT *, CAST(sum(length(piece) + length(coalesce(whole, ''))) OVER (PARTITION BY rid, rule ORDER BY i) AS BIGINT) AS e FROM m),
k AS (SELECT rid, rule, e - length(whole) AS s, e FROM p WHERE whole IS NOT NULL AND length(value) >= least)
SELECT doc_id, {", ".join(f"count(*) FILTER (WHERE rule = {n}) AS n_{rules[n][0]}" for n in range(3))},
  sha256({base}) AS base_sha256, {joined.format(names, "")} AS spans
FROM t LEFT JOIN k USING (rid) GROUP BY rid, doc_id"""


SQL = {
    "op1_host_quality": rf"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '{_WORD}') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines FROM t),
word AS (SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM w),
tri AS (SELECT doc_id, i, w AS a, lead(w) OVER o AS b, lead(w, 2) OVER o AS c
        FROM word WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n
        FROM tri WHERE c IS NOT NULL) WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (
        SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY doc_id),
s AS (SELECT w.doc_id, w.source, CAST(len(words) AS BIGINT) AS n_words,
        CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN cov USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s),
h AS (SELECT source, count(*) AS n, sum(CAST(base_failed AS BIGINT)) AS k FROM b
      WHERE source IS NOT NULL GROUP BY source),
m AS (SELECT sum(k) / sum(n) AS mean, sum(n * (k / n) * (k / n)) / sum(n) AS square FROM h),
p AS (SELECT mean, CASE WHEN square - mean * mean > 1e-12
        THEN least(10000.0, greatest(2.0, mean * (1 - mean) / (square - mean * mean) - 1)) ELSE 10000.0 END AS strength FROM m),
v AS (SELECT source, (k + mean * strength) / (n + strength) AS rate FROM h, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  round(rate, 9) AS host_rate, NOT base_failed AND NOT coalesce(rate > 0.5, false) AS kept
FROM b LEFT JOIN v USING (source)""",
    "op5_ngram_join": rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w),
n AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM s),
t AS (SELECT doc_id, unnest(s) AS t FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM t a JOIN t b ON a.t = b.t AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id),
e AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * k >= 80 * (x.n + y.n - k)),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT n.doc_id, n.n AS n_shingles, least(n.doc_id, coalesce(min(r.b), n.doc_id)) AS component_id
FROM n LEFT JOIN r ON n.doc_id = r.a GROUP BY n.doc_id, n.n""",
    "op7_preferences": f"""
WITH c AS (SELECT conv_id, list(struct_pack(role := r, text := x) ORDER BY turn, r, x) AS t
    FROM (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations
          WHERE conv_id IS NOT NULL) GROUP BY conv_id),
l AS (SELECT *, coalesce(list_max(list_filter(range(1, len(t) + 1), lambda i: t[i].role = 'assistant')), 0) AS last FROM c),
o AS (SELECT *, t[last] AS answer, count(*) OVER () AS n FROM l WHERE last > 0),
q AS (SELECT conv_id AS chosen_id, coalesce(lead(conv_id) OVER w, first_value(conv_id) OVER w) AS rejected_id, n,
        t[1:last] AS a, list_append(t[1:last - 1], coalesce(lead(answer) OVER w, first_value(answer) OVER w)) AS b
      FROM o WINDOW w AS (ORDER BY conv_id)),
n AS (SELECT *, len(list_filter(range(1, least(len(a), len(b)) + 1), lambda i: a[1:i] = b[1:i])) AS k FROM q WHERE n > 1),
r AS (SELECT chosen_id, rejected_id, k, a[1:k] AS pre, a[k + 1:] AS a, b[k + 1:] AS b FROM n)
SELECT chosen_id, rejected_id, CAST(k AS INTEGER) AS prefix_turns,
  {_rendered("pre")} AS prompt, {_rendered("a")} AS chosen, {_span_text("a")} AS chosen_spans,
  {_rendered("b")} AS rejected, {_span_text("b")} AS rejected_spans FROM r
UNION ALL SELECT conv_id, NULL, 0, '', {_rendered("t")}, {_span_text("t")}, NULL, NULL FROM l
WHERE last = 0 OR (SELECT count(*) FROM o) = 1""",
    "op7_opening_preferences": f"""
WITH c AS (SELECT conv_id, list(struct_pack(role := r, text := x) ORDER BY turn, r, x) AS t
    FROM (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations
          WHERE conv_id IS NOT NULL) GROUP BY conv_id),
s AS (SELECT *, coalesce(list_sum(list_transform(list_filter(t, lambda x: x.role = 'assistant'),
        lambda x: length(x.text))), 0) AS size FROM c),
o AS (SELECT *, row_number() OVER w AS place, lag(conv_id) OVER w AS before, lag(t) OVER w AS before_t,
        lag(size) OVER w AS before_size,
        place % 2 = 1 AND lead(conv_id) OVER w IS NULL AS single FROM s
      WINDOW w AS (PARTITION BY t[1].role, t[1].text ORDER BY conv_id)),
p AS (SELECT before_size >= size AS keep, * FROM o WHERE place % 2 = 0),
q AS (SELECT CASE WHEN keep THEN before ELSE conv_id END AS chosen_id,
        CASE WHEN keep THEN conv_id ELSE before END AS rejected_id,
        CASE WHEN keep THEN before_t ELSE t END AS a, CASE WHEN keep THEN t ELSE before_t END AS b FROM p),
n AS (SELECT *, len(list_filter(range(1, least(len(a), len(b)) + 1), lambda i: a[1:i] = b[1:i])) AS k FROM q),
r AS (SELECT chosen_id, rejected_id, k, a[1:k] AS pre, a[k + 1:] AS a, b[k + 1:] AS b FROM n)
SELECT chosen_id, rejected_id, CAST(k AS INTEGER) AS prefix_turns,
  {_rendered("pre")} AS prompt, {_rendered("a")} AS chosen, {_span_text("a")} AS chosen_spans,
  {_rendered("b")} AS rejected, {_span_text("b")} AS rejected_spans FROM r
UNION ALL SELECT conv_id, NULL, 0, '', {_rendered("t")}, {_span_text("t")}, NULL, NULL FROM o WHERE single""",
    "op9_warc_salvage": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS winner FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> winner THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> winner THEN winner END AS refers_to FROM m""",
    "op10_site_lines": rf"""
WITH l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE text IS NOT NULL),
n AS (SELECT source, count(*) AS pages FROM documents WHERE source IS NOT NULL GROUP BY source),
c AS (SELECT source, line, count(DISTINCT doc_id) AS k FROM l
      WHERE source IS NOT NULL AND regexp_matches(line, '{_WORD}') GROUP BY source, line),
b AS (SELECT source, line FROM c JOIN n USING (source) WHERE k >= 5 AND k > 0.2 * pages),
f AS (SELECT l.*, b.line IS NOT NULL AS drop_it FROM l LEFT JOIN b ON l.source = b.source AND l.line = b.line),
g AS (SELECT doc_id, count(*) AS n_lines, sum(CAST(drop_it AS BIGINT)) AS n_dropped,
        coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT drop_it), '') AS kept FROM f GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_dropped, 0) AS BIGINT) AS n_dropped,
  CASE WHEN text IS NULL THEN NULL ELSE kept END AS text FROM documents LEFT JOIN g USING (doc_id)""",
    "op12_centroid_clusters": _cluster_sql(),
    "op13_secret_scan": _secrets_sql(),
}
