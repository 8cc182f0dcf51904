"""The queries of this subpackage and, where SQL can express them, the same as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, centroids, fingerprint, language_id, lexical, license_scan, line_dedup, media, mixing, secret_scan, sharding, simhash, url_filter
from .common import table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), bpe.default_path(), with_ids=False)


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.follow_and_compare(table(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.train(docs))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op10_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_features(media.media_column(table(spark, sf_dir, "documents")))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_common_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"), "most_docs")


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (op1_license_scan, op2_mixing, op3_bpe, op4_fingerprints, op5_sharding, op6_secret_scan, op7_language_id, op8_simhash, op9_url_filter, op10_media, op11_line_dedup, op12_centroids, op13_lexical_search, pipeline)
    return {f.__name__: f for f in named}


_WEIGHT = "CASE {column} {cases} ELSE {other} END"


def _weights(column: str, weights: dict[str, int]) -> str:
    if not weights:
        return str(mixing.DEFAULT_WEIGHT)
    return _WEIGHT.format(column=column, cases=" ".join(f"WHEN '{k}' THEN {v}" for k, v in weights.items()), other=mixing.DEFAULT_WEIGHT)


def _level(name: str, parents: list[str], level: str, weights: dict[str, int], up: str | None) -> str:
    """One level of shares: lambda of the water level is found as the last node, by capacity per weight, that is full."""
    keys = ", ".join([*parents, level])
    part = f"PARTITION BY {', '.join(parents)}" if parents else ""
    given = "(SELECT total FROM goal)" if up is None else "u.budget"
    source = "" if up is None else f"JOIN {up} u ON " + " AND ".join(f"u.{p} IS NOT DISTINCT FROM n.{p}" for p in parents)
    return f"""
{name}_n AS (SELECT {keys}, sum(supply * 2)::HUGEINT AS capacity, ({_weights(level, weights)})::HUGEINT AS weight FROM leaves GROUP BY {keys}),
{name}_g AS (SELECT n.*, ({given})::HUGEINT AS given, (n.capacity::DOUBLE / n.weight::DOUBLE)::DECIMAL(38,12) AS ratio FROM {name}_n n {source}),
{name}_l AS (SELECT *, given - coalesce(sum(capacity) OVER ({part} ORDER BY ratio, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS lft,
    (sum(weight) OVER ({part} ORDER BY ratio, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::HUGEINT AS weights FROM {name}_g),
{name}_f AS (SELECT *, lft > 0 AND capacity * weights <= lft * weight AS is_full FROM {name}_l),
{name}_p AS (SELECT *, max(lft) OVER (PARTITION BY {', '.join([*parents, 'is_full'])}) AS pool, max(weights) OVER (PARTITION BY {', '.join([*parents, 'is_full'])}) AS pool_w FROM {name}_f),
{name} AS (SELECT {keys}, capacity, least(capacity, CASE WHEN is_full THEN capacity ELSE greatest(0, pool * weight // pool_w) END)::HUGEINT AS budget FROM {name}_p)"""


def _mixing_sql() -> str:
    digit = "substr(md5(coalesce(source, '')), 1, 1)"
    order = f"md5('{mixing.SEED}:' || (budget // nullif(supply, 0))::VARCHAR || ':' || doc_id::VARCHAR)"
    return f"""
WITH docs AS (
  SELECT doc_id, CASE WHEN {digit} < '4' THEN 'web' WHEN {digit} < '8' THEN 'books' WHEN {digit} < 'c' THEN 'code' ELSE 'forum' END AS domain, lang, source,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS n_tokens FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS supply FROM docs GROUP BY ALL),
goal AS (SELECT (sum(supply) * 3 // 4)::HUGEINT AS total FROM leaves),
{_level('lev1', [], 'domain', mixing.DOMAIN_WEIGHTS, None)},
{_level('lev2', ['domain'], 'lang', mixing.LANGUAGE_WEIGHTS, 'lev1')},
{_level('lev3', ['domain', 'lang'], 'source', mixing.SOURCE_WEIGHTS, 'lev2')},
placed AS (
  SELECT d.*, b.budget, b.capacity // 2 AS supply, b.budget // nullif(b.capacity // 2, 0) AS whole
  FROM docs d JOIN lev3 b ON b.domain = d.domain AND b.lang IS NOT DISTINCT FROM d.lang AND b.source IS NOT DISTINCT FROM d.source),
summed AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY {order}) AS upto FROM placed)
SELECT doc_id, domain, lang, source, n_tokens, epoch FROM (
  SELECT *, unnest(range(0, whole::BIGINT)) AS epoch FROM summed
  UNION ALL BY NAME
  SELECT *, whole::BIGINT AS epoch FROM summed WHERE upto <= budget - whole * supply)"""


def _license_sql() -> str:
    """Words as lists; phrases compared in a row at every place, notices and whole texts with the different words of every block."""
    listed = lambda phrase: "[" + ", ".join(f"'{w}'" for w in phrase.split()) + "]"
    own = [t for t in license_scan.templates() if not t.exact]
    words = lambda t: "[" + ", ".join(f"'{w}'" for w in dict.fromkeys(x.decode() for x in t.words)) + "]"
    starts = ", ".join(f"list_filter(range(1, len(ws) - {len(p.split()) - 2}), lambda i: ws[i] = '{p.split()[0]}' AND ws[i:i + {len(p.split()) - 1}] = {listed(p)}) AS s{k}" for k, (p, _) in enumerate(license_scan.BASE_PHRASES))
    held = ", ".join(f"coalesce(list_max(list_transform(range(0, len(ws), {t.stride}), lambda b: len(list_intersect(list_distinct(ws[b + 1:b + {2 * t.stride}]), {words(t)})))), 0) / {len(set(t.words))}.0::DOUBLE AS h{k}" for k, t in enumerate(own))
    base = ", ".join(f"CASE WHEN len(s{k}) > 0 THEN '{label}' END" for k, (_, label) in enumerate(license_scan.BASE_PHRASES))
    more = ", ".join(f"CASE WHEN h{k} >= {share} - 1e-9 THEN '{label}' END" for k, (label, share) in enumerate((t.label, t.threshold) for t in own))
    scores = ", ".join([*(f"CASE WHEN len(s{k}) > 0 THEN 1.0 ELSE 0 END" for k in range(len(license_scan.BASE_PHRASES))), *(f"CASE WHEN h{k} >= {share} - 1e-9 THEN h{k} ELSE 0 END" for k, share in enumerate(t.threshold for t in own))])
    all_ = "flatten([" + ", ".join(f"s{k}" for k in range(len(license_scan.BASE_PHRASES))) + "])"
    joined = lambda labels: f"coalesce(array_to_string(list_sort(list_distinct(list_filter([{labels}], lambda x: x IS NOT NULL))), ','), '')"
    return f"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
f AS (SELECT doc_id, len(ws) AS n, {starts}, {held} FROM w)
SELECT doc_id, n::BIGINT AS n_words, len({all_})::BIGINT AS n_base, list_min({all_})::BIGINT - 1 AS first_word, list_max({all_})::BIGINT - 1 AS last_word, {joined(base)} AS base_labels, {joined(base + ', ' + more)} AS labels, greatest({scores})::DOUBLE AS score FROM f"""


def _url_sql() -> str:
    quoted = lambda s: s.replace("'", "''")
    values = ", ".join(f"('{v}', '{quoted(h)}', '{quoted(p)}')" for v, h, p in url_filter.BASE_RULES)
    own = " OR ".join(f"regexp_matches(host || path, '{quoted(p)}')" for v, p, _ in url_filter.PATTERNS if v == "block")
    rest = "substr(url, strpos(url, '://') + 3)"
    return f"""
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN translate(regexp_extract({rest}, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN strpos(url, '://') > 0 THEN regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path FROM pages),
base(v, h, p) AS (VALUES {values}),
fits AS (
  SELECT page_id, max_by(h || p, length(h || p)) AS rule, max_by(v, length(h || p)) AS v
  FROM parts JOIN base ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN {own} THEN 'block' ELSE 'allow' END) AS verdict FROM parts LEFT JOIN fits USING (page_id)"""


def _line_sql() -> str:
    """Lines one a row, keys counted by document."""
    space = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
each AS (SELECT r, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM d),
keyed AS MATERIALIZED (SELECT *, translate(trim(line, {space}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM each),
common AS (SELECT k, count(DISTINCT r) AS n FROM keyed WHERE length(k) >= {line_dedup.MIN_CHARS} GROUP BY k HAVING count(DISTINCT r) >= {line_dedup.MIN_DOCS})
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256, most_docs FROM (
  SELECT r, doc_id, count(*)::BIGINT AS n_lines, count(n)::BIGINT AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE n IS NULL), '') AS kept, max(n)::BIGINT AS most_docs
  FROM keyed LEFT JOIN common USING (k) GROUP BY r, doc_id)"""


def _centroid_sql() -> str:
    """Components one a row; every round written out."""
    c = centroids
    rounds = [
        f"""
c0 AS MATERIALIZED (SELECT n, p, x FROM v JOIN (SELECT r, row_number() OVER (ORDER BY sha256('{c.SEED}:' || vec_id)) - 1 AS n FROM kept QUALIFY n < {c.CLUSTERS}) USING (r))"""
    ]
    for i in range(c.ROUNDS + 1):
        rounds.append(f"""
a{i} AS MATERIALIZED (SELECT r, arg_min(n, (d, n)) AS n, min(d) AS d FROM (SELECT r, c.n, sum((v.x - c.x) * (v.x - c.x))::BIGINT AS d FROM v JOIN c{i} c USING (p) GROUP BY r, c.n) GROUP BY r)""")
        if i < c.ROUNDS:
            rounds.append(f"""
c{i + 1} AS MATERIALIZED (SELECT o.n, o.p, coalesce(m.x, o.x) AS x FROM c{i} o LEFT JOIN (SELECT n, p, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*))::BIGINT // count(*) AS x FROM v JOIN a{i} USING (r) GROUP BY n, p) m USING (n, p))""")
    return f"""
WITH rows_ AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings),
kept AS MATERIALIZED (SELECT r, vec_id, embedding FROM rows_ WHERE len(embedding) = {c.DIMENSIONS} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {c.DIMENSIONS}),
v AS MATERIALIZED (SELECT r, unnest(range({c.DIMENSIONS})) AS p, floor({c.SCALE} * unnest(embedding)::DOUBLE)::BIGINT AS x FROM kept),{",".join(rounds)},
s AS (SELECT n, sha256(string_agg(x::VARCHAR, ',' ORDER BY p)) AS centroid_sha256 FROM c{c.ROUNDS} GROUP BY n),
t AS (SELECT n, sum(d)::BIGINT AS cluster_inertia FROM a{c.ROUNDS} GROUP BY n)
SELECT vec_id, n::INT AS cluster, d AS distance, cluster_inertia, (SELECT sum(cluster_inertia) FROM t)::BIGINT AS inertia, centroid_sha256 FROM a{c.ROUNDS} JOIN kept USING (r) JOIN s USING (n) JOIN t USING (n)"""


def _lexical_sql() -> str:
    """Terms one a row; every item's terms joined with all documents that hold them."""
    x = lexical
    terms = f"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {terms} AS ts FROM documents),
total AS (SELECT count(*)::BIGINT AS n, sum(len(ts))::BIGINT AS l FROM d WHERE len(ts) > 0),
m AS (SELECT r, doc_id, {x.BASE} + (({x.SHARE} * len(ts)::BIGINT * n) // l) AS m FROM d, total WHERE len(ts) > 0),
tf AS MATERIALIZED (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(ts) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY term, n),
asked AS (SELECT q, item_id, unnest(ts) AS term FROM (SELECT row_number() OVER () AS q, item_id, {terms} AS ts FROM benchmark)),
scored AS (SELECT q, item_id, doc_id, r, sum(w * (({x.IMPACT} * tf) // (1000 * tf + {x.FACTOR} * m)))::BIGINT AS score FROM asked JOIN tf USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY ALL)
SELECT item_id, rank::INT AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= {x.TOP}"""


def oracle_sql() -> dict[str, str]:
    return {"op1_license_scan": _license_sql(), "op2_mixing": _mixing_sql(), "op9_url_filter": _url_sql(), "op11_line_dedup": _line_sql(), "op12_centroids": _centroid_sql(), "op13_lexical_search": _lexical_sql()}
