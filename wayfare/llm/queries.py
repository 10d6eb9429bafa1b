"""The registered queries of the operators, over whole tables, with the columns their users agreed on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm import alignment, chat, contamination, html_text, language, licences, near_duplicates, neighbours, packing, prefix_trie, sharding, toxicity, urls
from wayfare.llm.tables import fold, read

SHARDS = 8
SEQUENCE = 1024
TOXIC = 0.3


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(read(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.transform("mask", lambda s: F.concat_ws(":", s["start"].cast("string"), s["length"].cast("string")))
    return chat.rotate(read(spark, sf_dir, "conversations")).withColumn("mask", F.array_join(spans, ","))


def licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(read(spark, sf_dir, "documents"))


def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(fold(F.col("doc_id"), 4) != 2))
    held_out = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    predicted = (F.col("score") >= TOXIC).cast("int")
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"), "n_segments", "first_word", "last_word"
    )


def nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.cluster(read(spark, sf_dir, "documents"), words=2)


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = language.fit(docs.where(fold(F.col("doc_id"), 3) != 1))
    held_out = F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False))
    return language.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "margin", "rejected")


def contaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.find(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def page_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    listed = pages.where(urls.host_of(F.col("url")).rlike(UNWANTED)).select(urls.canonical(F.col("url")).alias("canonical_url"))
    return urls.judge(pages, listed, RULES)


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), *packing.vocabulary(), most=SEQUENCE, digest=True)


def main_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages"))


def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.share(read(spark, sf_dir, "conversations"))


def aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read(spark, sf_dir, "documents"), *alignment.vocabularies())


#: Rules (verdict, host, path).
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
#: The block list holds the canonical URLs of pages whose host has such a word in its name.
UNWANTED = "(^|[.-])(spam|adult|casino|pills|bets|ads)([.-]|$)"

QUERIES = {
    "op1_sharding": shards,
    "op2_perspectives": perspectives,
    "op3_licences": licence_scan,
    "op4_toxicity": toxic,
    "op5_neighbours": nearest,
    "op6_near_duplicates": near_copies,
    "op7_language": languages,
    "op8_decontamination": contaminated,
    "op9_urls": page_verdicts,
    "op10_packing": packed,
    "op11_html": main_texts,
    "op12_prefix_trie": conversation_trie,
    "op13_alignment": aligned,
}

_HOST = "translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES = {
    "op2_perspectives": """
WITH rows AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos FROM rows
), speakers AS (
  SELECT DISTINCT conv_id, role AS perspective FROM rows WHERE role <> 'system'
), shown AS (
  SELECT n.conv_id, perspective, pos, (pos // 32)::INTEGER AS part, role = perspective AS own, replace(text, '<|', '<||') || '<|end|>' || chr(10) AS body,
    CASE WHEN role = 'system' THEN '<|system|>' WHEN role = perspective THEN '<|assistant|>'
      ELSE '<|user name=' || replace(replace(role, '<|', '<||'), '|>', '||>') || '|>' END || chr(10) AS head
  FROM numbered n JOIN speakers s ON n.conv_id = s.conv_id
), spans AS (
  SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, perspective, part ORDER BY pos) - length(body) AS start
  FROM shown
)
SELECT conv_id, perspective, part, count(*) AS n_messages, string_agg(head || body, '' ORDER BY pos) AS text,
  coalesce(string_agg(start::BIGINT || ':' || length(body), ',' ORDER BY pos) FILTER (WHERE own), '') AS mask
FROM spans GROUP BY conv_id, perspective, part""",
    # All pairs that share a shingle, so this is brute force.
    "op6_near_duplicates": r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents WHERE doc_id IS NOT NULL
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) < 2 THEN [words] ELSE
    list_transform(range(1, len(words)), lambda i: words[i:i + 1]) END) AS shingle
  FROM docs WHERE len(words) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), numbers AS (
  SELECT shingle, row_number() OVER () AS number FROM (SELECT shingle FROM shingles GROUP BY shingle HAVING count(*) > 1)
), coded AS (
  SELECT doc_id, number FROM shingles JOIN numbers USING (shingle)
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM coded a JOIN coded b ON a.number = b.number AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)
), ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT DISTINCT a AS node, a AS other FROM ways UNION SELECT r.node, b FROM reach r JOIN ways ON a = r.other
), components AS (
  SELECT node, min(other) AS component FROM reach GROUP BY node
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component, doc_id) AS component_id, coalesce(component, doc_id) = doc_id AS kept
FROM docs LEFT JOIN sizes USING (doc_id) LEFT JOIN components ON node = doc_id""",
    "op9_urls": f"""
WITH rows AS (
  SELECT page_id, {_HOST} AS host, coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path,
    coalesce(regexp_extract(url, '^[^?#]*\\?([^#]*)', 1), '') AS query
  FROM pages
), cleaned AS (
  SELECT *, regexp_replace(host, '^(www|m)\\.', '') AS bare,
    regexp_replace(regexp_replace(path, '/+$', ''), '\\.html?$', '') AS short,
    list_filter(string_split(query, '&'), lambda x: x <> '' AND NOT regexp_full_match(x, '(utm_[^=&]*|ref|fbclid|gclid)(=.*)?')) AS kept
  FROM rows
), canon AS (
  SELECT *, CASE WHEN bare <> '' THEN bare || short || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END AS canonical_url
  FROM cleaned
), listed AS (
  SELECT DISTINCT canonical_url FROM canon WHERE canonical_url IS NOT NULL
    AND regexp_matches(host, '(^|[.-])(spam|adult|casino|pills|bets|ads)([.-]|$)')
), rules(verdict, name, start) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), judged AS (
  SELECT c.*, (
    SELECT struct_pack(rule := name || start, verdict := verdict) FROM rules
    WHERE (c.host = name OR ends_with(c.host, '.' || name)) AND starts_with(c.path, start) ORDER BY length(name || start) DESC LIMIT 1
  ) AS found, canonical_url IS NOT NULL AND canonical_url IN (SELECT canonical_url FROM listed) AS listed
  FROM canon c
)
SELECT page_id, host, path, found.rule AS rule, coalesce(found.verdict, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict, canonical_url, listed
FROM judged""",
    # On these pages the region is always the article, so its blocks state the result.
    "op11_html": r"""
WITH articles AS (
  SELECT page_id, url, coalesce(regexp_extract(html, '<article>(.*?)(</article>|$)', 1, 's'), '') AS article FROM pages
), blocks AS (
  SELECT page_id, url, list_transform(
    regexp_split_to_array(article, '</?(p|h1)>'),
    lambda block: trim(regexp_replace(regexp_replace(regexp_replace(block, '<br>', ' ', 'g'), '<[^<>]*>', '', 'g'), '\s+', ' ', 'g'))
  ) AS blocks
  FROM articles
), texts AS (
  SELECT page_id, url, array_to_string(list_filter(list_transform(blocks,
    lambda block: replace(replace(regexp_replace(replace(replace(block, '&lt;', '<'), '&gt;', '>'), '&quot;?', '"', 'g'),
      '&amp;', '&'), '&amp', '&')), lambda block: block <> ''), chr(10)) AS text
  FROM blocks
)
SELECT page_id, url, text, length(text) AS n_chars FROM texts""",
    # CRC-32 by its definition: the bytes of the decimal id, eight shifts each.
    "op12_prefix_trie": """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, count(*) AS n FROM turns GROUP BY conv_id
), hashed AS (
  SELECT conv_id, n, conv_id - conv_id % 100 AS base,
    xor(list_reduce(
      list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda crc, byte: list_reduce(
        list_concat([xor(crc, byte)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda rest, step: xor(rest >> 1, CASE WHEN rest & 1 = 1 THEN 3988292384 ELSE 0 END))
    ), 4294967295::BIGINT) % 6 AS h
  FROM own
), sized AS (
  SELECT c.conv_id, c.base, c.h, least(c.h, coalesce(b.n, 0)) AS taken FROM hashed c LEFT JOIN own b ON b.conv_id = c.base
), rebuilt AS (
  SELECT s.conv_id, pos + 1 AS depth, role, text FROM sized s JOIN turns t ON t.conv_id = s.base AND pos < taken
  UNION ALL
  SELECT s.conv_id, taken + pos - h + 1, role, text FROM sized s JOIN turns t ON t.conv_id = s.conv_id AND pos >= h
), whole AS (
  SELECT s.conv_id, coalesce(list({'r': role, 't': text} ORDER BY depth) FILTER (WHERE depth IS NOT NULL), []) AS turns
  FROM sized s LEFT JOIN rebuilt r ON r.conv_id = s.conv_id GROUP BY s.conv_id
), ways AS (
  SELECT conv_id, depth, turns[1:depth] AS node, len(turns) = depth AS ends
  FROM (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS depth FROM whole)
), nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM ways GROUP BY node, depth
), valued AS (
  SELECT n.*, p.conv_id AS parent_conv_id, CASE WHEN n.depth > 0 THEN (n.n_convs - 1) * length(n.node[n.depth].t) ELSE 0 END AS saved
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.node = n.node[1:n.depth - 1]
), counted AS (
  SELECT v.*, coalesce(n_children, 0) AS n_children
  FROM valued v LEFT JOIN (
    SELECT depth - 1 AS depth, node[1:depth - 1] AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
  ) c ON c.depth = v.depth AND c.node = v.node
), totals AS (
  SELECT w.node, sum((n_children = 0)::BIGINT) AS n_leaves, sum(saved) AS saved_tokens
  FROM counted u JOIN ways w ON w.conv_id = u.conv_id AND w.depth <= u.depth GROUP BY w.node
)
SELECT conv_id, c.depth::BIGINT AS depth, parent_conv_id, n_convs, n_children, n_leaves::BIGINT AS n_leaves,
  saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM counted c JOIN totals t ON t.node = c.node""",
}
