"""One query per operator of this subpackage over its whole table, with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    conversations, decontaminate, exact_dedup, minhash, mixing, passages, pii, sharding, simhash, spelling, suffix_tree, token_files, toxicity,
)
from ledgerloom.llm.text import documents
from ledgerloom.session import new_shared_path

TOKENIZER = "byte_bpe_50k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return function

    return register


@query(r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY ALL)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
""")
def op1_exact_dedup(spark, sf_dir):
    """The table in two batches of ids against a fresh index."""
    index = exact_dedup.DigestIndex.fresh(spark)
    rows = exact_dedup.exact_dedup(documents(spark, sf_dir), index, batches=2)
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query()
def op2_simhash(spark, sf_dir):
    rows = simhash.simhash_groups(documents(spark, sf_dir))
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query()
def op3_mixing(spark, sf_dir):
    rows = mixing.mix(documents(spark, sf_dir))
    return rows.select("doc_id", "size", "source_size", "target", "taken", "copies")


@query()
def op4_lm_scoring(spark, sf_dir):
    return suffix_tree.fit_and_score(documents(spark, sf_dir))


@query()
def op5_sharding(spark, sf_dir):
    rows = sharding.shard(documents(spark, sf_dir))
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query(rf"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '{decontaminate.BREAK}'), lambda x: x <> '') AS w FROM documents),
b AS (
  SELECT item_id::VARCHAR AS item, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '{decontaminate.BREAK}'), lambda x: x <> '') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(w), 10) AS k, list_slice(w, i, i + least(len(w), 10) - 1) AS win
       FROM b, LATERAL (SELECT unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i) WHERE len(w) > 0),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT doc_id, k, i, list_slice(w, i, i + k - 1) AS win FROM d, ks, LATERAL (SELECT unnest(range(1, greatest(len(w) - k + 2, 1))) AS i)),
h AS (SELECT DISTINCT doc_id, dw.k, i, item FROM dw JOIN bw USING (win)),
p AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM h, LATERAL (SELECT unnest(range(i, i + k)) AS j) GROUP BY doc_id),
m AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN m USING (doc_id)
""")
def op6_decontamination(spark, sf_dir):
    rows = decontaminate.contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return rows.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query()
def op7_pii(spark, sf_dir):
    rows = pii.find(documents(spark, sf_dir))

    def number(kind: str):
        return F.size(F.filter("base", lambda x: x["kind"] == pii.KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    return rows.select(
        "doc_id", *[number(k) for k in ("email", "ip", "card", "phone")],
        F.sha2(pii.written("base").cast("binary"), 256).alias("base_sha256"), pii.written("spans").alias("spans"),
    )


@query()
def op8_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


@query()
def op9_substring_dedup(spark, sf_dir):
    return passages.passages(documents(spark, sf_dir))


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op10_token_output(spark, sf_dir):
    path = new_shared_path(spark, "tokens")
    token_files.write_tokens(documents(spark, sf_dir), path, tokenizer_path())
    return token_files.read_tokens(spark, path)


@query(r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS v
      FROM d, LATERAL (SELECT unnest(range(1, greatest(len(w) - 3, 2))) AS i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.v = b.v AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
reach AS (SELECT doc_id, doc_id AS other FROM d UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(other) AS component_id, d.doc_id = min(other) AS kept
FROM d JOIN reach USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id
""")
def op13_minhash(spark, sf_dir):
    return minhash.near_duplicates(documents(spark, sf_dir))


# CRC-32 of the UTF-8 bytes of ``s``; ``tab`` is the column of CRC_TABLE.
CRC_TABLE = """tab AS (
  SELECT list(c ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) t(i)))"""


def crc_sql(s: str) -> str:
    digit = "(strpos('0123456789ABCDEF', substr({h}, {at}, 1)) - 1)"
    high, low = digit.format(h=f"hex(encode({s}))", at="2 * k + 1"), digit.format(h=f"hex(encode({s}))", at="2 * k + 2")
    data = f"list_transform(range(octet_length(encode({s}))), lambda k: 16 * {high} + {low})"
    return f"xor(list_reduce(list_prepend(4294967295, {data}), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)"


@query(rf"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
  SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r, count(*) AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS r FROM documents) GROUP BY ALL),
hashed AS (SELECT r, k, {crc_sql("(coalesce(doc_id::VARCHAR, '') || ':' || r)")} AS h FROM runs, tab),
words AS (
  SELECT w AS word, sum(k)::BIGINT AS n
  FROM (SELECT k, CASE WHEN h % 97 = 0 THEN left(r, (h % length(r))::BIGINT) || substr(r, (h % length(r))::BIGINT + 2) ELSE r END AS w FROM hashed)
  WHERE length(w) >= 5 GROUP BY w HAVING sum(k) >= 3),
cut AS (SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS v FROM words, LATERAL (SELECT unnest(range(1, length(word) + 1)) AS i)),
one AS (
  SELECT a.word AS a, b.word AS b FROM cut a JOIN cut b ON a.i = b.i AND a.v = b.v AND a.word <> b.word
  UNION SELECT c.word, w.word FROM cut c JOIN words w ON c.v = w.word
  UNION SELECT w.word, c.word FROM cut c JOIN words w ON c.v = w.word),
best AS (
  SELECT a AS word, count(*) AS n_near, max(w.n) AS top, min(b ORDER BY b) FILTER (WHERE w.n = m.top) AS form
  FROM one JOIN words w ON w.word = b JOIN (SELECT a AS x, max(n) AS top FROM one JOIN words ON word = b GROUP BY a) m ON m.x = a GROUP BY a),
forms AS (
  SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN top >= 2 * n THEN form END AS form, CASE WHEN top >= 2 * n THEN top END AS form_n
  FROM words LEFT JOIN best USING (word)),
follow AS (
  SELECT word, word AS last, 0 AS step FROM words
  UNION ALL SELECT f.word, g.form, f.step + 1 FROM follow f JOIN forms g ON g.word = f.last WHERE g.form IS NOT NULL)
SELECT word, form, arg_max(last, step) AS root, any_value(n) AS n, any_value(n_near) AS n_near, any_value(form_n) AS form_n
FROM forms JOIN follow USING (word) GROUP BY word, form
""")
def op12_spelling(spark, sf_dir):
    return spelling.variants(spelling.word_counts(documents(spark, sf_dir), spelling.DAMAGE))


def _with_cost(state: str, cost: str, letter: str) -> str:
    """A state of the parse is its cost in nine digits, then its audit: the least text is the cheapest, then the first."""
    return f"(lpad((left({state}, 9)::BIGINT + {cost})::VARCHAR, 9, '0') || substr({state}, 10) || '{letter}')"


def _step_sql() -> str:
    def ways(initial: str, sources: list[int]) -> str:
        kept = [f"CASE WHEN initial = '{initial}' THEN {_with_cost(f's{p}', 'keep', 'K')} END" for p in sources]
        return ", ".join(kept + ([_with_cost(f"s{p}", "keep + 3", "R") for p in sources] if initial != "s" else []))

    gone = [_with_cost(f"s{p}", "4", "D") for p in range(4)]
    return (
        f"{gone[0]} AS n0, least({gone[1]}, {ways('s', [0])}) AS n1, least({gone[2]}, {ways('u', [0, 1, 3])}) AS n2, least({gone[3]}, {ways('a', [2])}) AS n3"
    )


@query(rf"""
WITH RECURSIVE {CRC_TABLE},
hashed AS (
  SELECT coalesce(conv_id::VARCHAR, ' ') AS k, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc_sql("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS h FROM conversations, tab),
damaged AS (
  SELECT k, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN h = 1 THEN '' WHEN h = 2 THEN translate(text, '.!?', '') ELSE text END AS text, copy
  FROM hashed, LATERAL (SELECT unnest(range(CASE h WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy)),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, text, copy) AS i, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM damaged),
faulty AS (
  SELECT *, left(role, 1) AS initial, CASE WHEN body = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY k, role, text ORDER BY i) > 1 THEN 'duplicate'
         WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM numbered),
r AS (
  SELECT *, CASE fault WHEN '' THEN 0 WHEN 'truncated' THEN 3 END AS keep,
         i > 1 AND lag(initial) OVER (PARTITION BY k ORDER BY i) || initial NOT IN ('su', 'ua', 'au') AS illegal FROM faulty),
c AS (SELECT k, any_value(conv_id) AS conv_id FROM hashed GROUP BY k),
parse AS (
  SELECT k, 0::BIGINT AS i, '000000000' AS s0, NULL::VARCHAR AS s1, '000000003I' AS s2, '000000006II' AS s3 FROM c
  UNION ALL
  SELECT k, i, n0, n1, m2, least(n3, {_with_cost("m2", "3", "I")}) FROM (
    SELECT *, least(n2, {_with_cost("n0", "3", "I")}, {_with_cost("n1", "3", "I")}, {_with_cost("n3", "3", "I")}) AS m2 FROM (
      SELECT r.k, r.i, {_step_sql()} FROM parse JOIN r ON parse.k = r.k AND r.i = parse.i + 1))),
won AS (SELECT k, arg_max(least(s0, s3), i) AS best FROM parse GROUP BY k),
edits AS (
  SELECT k, j, e, count(*) FILTER (WHERE e <> 'I') OVER w AS i, count(*) FILTER (WHERE e <> 'D') OVER w AS place,
         count(*) FILTER (WHERE e <> 'D') OVER (PARTITION BY k) AS n
  FROM (SELECT k, j, substr(best, 9 + j, 1) AS e FROM won, LATERAL (SELECT unnest(range(1, length(best) - 8)) AS j))
  WINDOW w AS (PARTITION BY k ORDER BY j)),
repaired AS (
  SELECT e.k, string_agg(CASE WHEN e.e = 'K' THEN r.role WHEN (place - n % 2) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e.e = 'I' THEN '' ELSE r.text END,
         chr(10) ORDER BY j) AS body
  FROM edits e LEFT JOIN r ON r.k = e.k AND r.i = e.i WHERE e.e <> 'D' GROUP BY e.k),
counts AS (
  SELECT k, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
         count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE illegal) AS illegal FROM r GROUP BY k)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, left(best, 9)::BIGINT AS cost, substr(best, 10) AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM c JOIN won USING (k) LEFT JOIN counts USING (k) LEFT JOIN repaired USING (k)
""")
def op11_conversations(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return conversations.repair_report(conversations.damage(rows), present_col="present")
