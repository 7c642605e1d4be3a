"""The operators applied to the given tables: ``opN_<name>`` with the column contract of each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import functools

from camstat.llm import (
    align,
    ann,
    bpe,
    chat,
    licenses,
    mixing,
    secretscan,
    sharding,
    simhash,
    tokenfiles,
    toxicity,
    vecdedup,
    vectorcodes,
)
from camstat.llm.common import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@functools.cache
def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def whole_text() -> Column:
    return F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")


@query
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded with the word BPE file."""
    path = tokenizer("word_bpe_49k.json")
    encode, decode = bpe.encode(spark, path), bpe.decode(spark, path)
    ids = table(spark, sf_dir, "documents").select("doc_id", encode(whole_text()).alias("ids"))
    return ids.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(decode(F.col("ids")).cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents: base patterns and zstandard novelty."""
    docs = table(spark, sf_dir, "documents")
    find = secretscan.scan(spark, secretscan.identifiers(docs))
    found = docs.select("doc_id", find(F.coalesce(F.col("text"), F.lit(""))).alias("found"))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = joined(F.filter("found", lambda s: s["kind"] != "novel"))
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"), count("novel"))


@query
def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest of every vector whose id is divisible by 50, among all others."""
    found = ann.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


#: Most passes over a source in the mixed stream.
REPEAT = 2.0


@query
def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by temperature: every document at least once, no source over twice."""
    return mixing.mix(table(spark, sf_dir, "documents"), mixing.Target(repeat=REPEAT))


ORACLES["op4_mix"] = r"""
WITH RECURSIVE rows AS (
  SELECT DISTINCT doc_id, source, md5(coalesce(text, '')) AS digest,
    CAST(length(coalesce(text, '')) - length(translate(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(13), '')) + 1 AS BIGINT) AS n_tokens,
    CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS src
  FROM documents
), totals AS (SELECT src, CAST(sum(n_tokens) AS BIGINT) AS total FROM rows GROUP BY src
), sources AS (SELECT src, total, total / CAST(sum(total) OVER () AS DOUBLE) AS share FROM totals
), bisect(k, low, high) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT k + 1,
    CASE WHEN met THEN low ELSE (low + high) / 2 END,
    CASE WHEN met THEN (low + high) / 2 ELSE high END
  FROM (SELECT b.*, (SELECT max(pow(share, (b.low + b.high) / 2) / share) * max(share / pow(share, (b.low + b.high) / 2)) <= 2.0 FROM sources) AS met
        FROM bisect b WHERE k < 24)
), found AS (
  SELECT CASE WHEN (SELECT max(1 / share) * max(share) <= 2.0 FROM sources) THEN 0.0 ELSE (SELECT high FROM bisect WHERE k = 24) END AS a
), sized AS (
  SELECT (SELECT sum(pow(share, a)) FROM sources, found) AS z, (SELECT max(total / pow(share, a)) FROM sources, found) AS longest
), stream AS (SELECT z, longest * z AS tokens, greatest(1, -(-CAST(floor(longest * z) AS BIGINT) // 1000000)) AS blocks FROM sized
), plan AS (
  SELECT src, total, CAST(floor(pow(share, a) / z * tokens + 0.5) AS BIGINT) AS budget, blocks FROM sources, found, stream
), used AS (
  SELECT r.*, p.total, p.budget, greatest(1, (p.budget + p.blocks - 1) // p.blocks) AS share_of_block, e.epoch
  FROM rows r JOIN plan p ON r.src = p.src, generate_series(0, greatest(0, (p.budget - 1) // p.total)) AS e(epoch)
), hashed AS (SELECT *, md5('mix:' || epoch || ':' || coalesce(doc_id::VARCHAR, digest)) AS hash FROM used
), laid AS (
  SELECT *, CAST(sum(n_tokens) OVER (PARTITION BY src, epoch ORDER BY hash, doc_id, n_tokens, digest ROWS UNBOUNDED PRECEDING) - n_tokens + epoch * total AS BIGINT) AS pos
  FROM hashed
), cut AS (SELECT *, pos // share_of_block AS block FROM laid WHERE pos < budget)
SELECT doc_id, source, n_tokens, CAST(epoch AS INTEGER) AS epoch, CAST(block AS BIGINT) AS block,
  CAST(row_number() OVER (PARTITION BY block ORDER BY md5(hash || ':' || block), src, doc_id, epoch, n_tokens, digest) - 1 AS BIGINT) AS slot
FROM cut
"""


@query
def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations plus conversation -7, whose texts are control strings."""
    own = spark.sql(
        "SELECT CAST(-7 AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, role, '</s>[INST] ok [/INST]' AS text "
        "FROM VALUES (0, 'user'), (1, 'assistant') AS t(turn, role)")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    out = chat.format_conversations(turns).select(
        "conv_id", "formatted", chat.parse(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLES["op5_chat_format"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, lag(role) OVER w AS prev,
    length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\]|\|(?:turn|text|more|end)\|>)', '\1\\\2\3', 'g')) AS n_text,
    length(regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\]|\|(?:turn|text|more|end)\|>)', '\1\\\2\3', 'g')) AS n_role
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(n_text + CASE WHEN prev IS NULL OR prev <> role THEN n_role + 23 ELSE 8 END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


@query
def op6_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate links and components of all vectors at a cosine of 0.95."""
    return vecdedup.near_duplicates(table(spark, sf_dir, "embeddings"), 0.95)


@query
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of all documents in bit-packed files, read back."""
    encode, vocabulary = tokenfiles.library_ids(spark, tokenizer("byte_bpe_50k.json"))
    files = tokenfiles.write_files(table(spark, sf_dir, "documents"), encode, vocabulary, end_id=0)
    return tokenfiles.read_files(files).select(
        F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


#: Score from which a document counts as toxic.
TOXIC = 0.3


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    """Fitted on the labelled rows that are not held out."""
    return toxicity.fit(docs, labels.where(~toxicity.held_out(F.col("doc_id"))))


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    docs = table(spark, sf_dir, "documents")
    score = toxicity.scorer(spark, toxicity_model(docs, table(spark, sf_dir, "labels")))
    return docs.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), score(F.col("text")).alias("score")).withColumn(
        "predicted", (F.col("score") >= TOXIC).cast("int"))


@query
def op9_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards by proportional stratified interleaving."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return sharding.interleave(docs, 24).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source")


@query
def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of all documents: 3-word shingles, at most 3 differing bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents spelt by the byte-level and the sentencepiece file, cut at common token ends."""
    docs = table(spark, sf_dir, "documents")
    return align.alignment(spark, docs, tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"), ["doc_id"], digest_only=True)


@query
def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of all documents."""
    return licenses.summary(licenses.scan(table(spark, sf_dir, "documents"), ["doc_id"]), ["doc_id"])


def _license_sql() -> str:
    base = [licenses._words(p) for p in licenses.BASE]
    rows = ",\n  ".join(f"({k}, '{r.label}', '{r.keyword}', '{r.pattern}', {r.priority}, {r.strength}, {str(r.pattern in base).lower()})"
                        for k, r in enumerate(licenses.rules()))
    return rf"""
WITH rules(rule, label, keyword, pattern, priority, strength, base) AS (VALUES
  {rows}
), split AS (
  SELECT row_number() OVER () AS id, doc_id, trim(regexp_replace(coalesce(text, ''), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+', '  ', 'g')) AS w FROM documents
), words AS MATERIALIZED (
  SELECT id, doc_id, translate(CASE WHEN w = '' THEN '' ELSE ' ' || w || ' ' END, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM split
), tried AS (
  SELECT id, w, r.*, regexp_extract_all(w, pattern) AS found FROM words JOIN rules r ON contains(w, keyword)
), placed AS (
  SELECT *, list_transform(regexp_split_to_array(w, pattern), lambda p: (length(p) - length(replace(p, ' ', ''))) // 2) AS before,
    list_transform(found, lambda m: (length(m) - length(replace(m, ' ', ''))) // 2) AS own
  FROM tried WHERE len(found) > 0
), finds AS MATERIALIZED (
  SELECT id, label, rule, priority, strength, base, CAST(list_sum(before[1:k]) + coalesce(list_sum(own[1:k - 1]), 0) AS BIGINT) AS s,
    CAST(list_sum(before[1:k]) + list_sum(own[1:k]) AS BIGINT) AS e
  FROM (SELECT *, unnest(range(1, len(found) + 1)) AS k FROM placed)
), kept AS (
  SELECT * FROM finds d WHERE base OR NOT EXISTS (
    SELECT 1 FROM finds o WHERE o.id = d.id AND o.s <= d.s AND o.e >= d.e AND o.priority >= d.priority
      AND (o.e - o.s > d.e - d.s OR o.rule < d.rule))
), per AS (
  SELECT id, count(*) FILTER (base) AS n_base, min(s) FILTER (base) AS first_word, max(s) FILTER (base) AS last_word,
    coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(strength) AS score
  FROM kept GROUP BY id
)
SELECT doc_id, CAST((length(w) - length(replace(w, ' ', ''))) // 2 AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
  first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM words LEFT JOIN per USING (id)
"""


ORACLES["op12_licenses"] = _license_sql()


@query
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors as four code bytes, with the errors of vectors and labels."""
    codes, books = vectorcodes.compress(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
    rows = codes.select(F.col("key").alias("vec_id"), "label", F.lower(F.regexp_replace(F.hex("code"), "(..)00", "$1")).alias("code"), "error")
    of_label = rows.groupBy(F.col("label").alias("__label")).agg(F.sum("error").alias("label_error"))
    return rows.join(of_label, F.col("label").eqNullSafe(F.col("__label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(vectorcodes.codebook_digest(books)).alias("codebooks_sha256"))


def _codes_sql(rounds: int = 4) -> str:
    near = """SELECT rid, p, any_value(x) AS x, min({{'d': CAST(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT), 'e': entry}}) AS m
  FROM parts JOIN b{t} USING (p) GROUP BY rid, p"""
    steps = []
    for t in range(rounds + 1):
        steps.append(f"a{t} AS MATERIALIZED (\n  {near.format(t=t)}\n)")
        if t < rounds:
            steps.append(f"""b{t + 1} AS MATERIALIZED (
  SELECT b.p, b.entry, coalesce(u.c, b.c) AS c FROM b{t} b LEFT JOIN (
    SELECT p, entry, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY pos) AS c FROM (
      SELECT p, m.e AS entry, pos, CAST(sum(x[pos]) AS BIGINT) AS s, count(*) AS n
      FROM a{t}, (SELECT unnest(range(1, (SELECT max(len(x)) FROM parts) + 1)) AS pos) GROUP BY ALL)
    GROUP BY p, entry) u ON b.p = u.p AND b.entry = u.entry
)""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT rid, p, v[p * (len(v) // 4) + 1:(p + 1) * (len(v) // 4)] AS x FROM kept, range(4) t(p)
), b0 AS (SELECT p, rid - 1 AS entry, x AS c FROM parts WHERE rid <= 256
), {", ".join(steps)}
, coded AS (
  SELECT rid, string_agg(format('{{:02x}}', m.e), '' ORDER BY p) AS code, CAST(sum(m.d) AS BIGINT) AS error FROM a{rounds} GROUP BY rid
), digest AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, entry)) AS codebooks_sha256 FROM b{rounds}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (rid), digest
"""


ORACLES["op13_vector_codes"] = _codes_sql()
