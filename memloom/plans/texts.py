"""Documents, templates, answers and citations over documents, benchmark and conversations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from memloom.functions import text
from memloom.operators import corpora, hooks, metrics, prompts, sequences

PREFIX, SUFFIX = "<|im_start|>user\n", "<|im_end|>\n<|im_start|>assistant\n"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def compose_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", text.composed(F.col("doc_id"), F.col("text")).alias("composed"))


def chunk_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = text.token_count(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", n.alias("n_tokens"), text.chunk_count(n, 64).alias("n_chunks"))


def corpus_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = chunk_counts(spark, sf_dir).withColumn("bucket", F.col("doc_id") % 8)
    return counted.groupBy("bucket").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"), F.sum("n_chunks").alias("n_chunks"))


def query_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts, and the place of the question's last token: the global offset is 3 + top-k."""
    asked = text.asked(F.col("text"), PREFIX, SUFFIX)
    roles = prompts.asked_roles(text.tokens(F.concat(F.lit(PREFIX), F.col("text"))), 3, 1)
    return table(spark, sf_dir, "benchmark").select("item_id", asked.alias("prompt"), F.array_join(roles, ",").alias("roles"), (text.token_count(F.col("text")) - 1 + 3 + 16).alias("last_position"))


def sort_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order in which all requests are served, by length, then as they came, and the batch of 64 that each is in."""
    rows = table(spark, sf_dir, "documents").select("doc_id", F.length("text").alias("n"))
    turn = sequences.ordinals(rows, "n", "doc_id", name="turn")
    return turn.select("doc_id", "turn", F.floor(F.col("turn") / 64).cast("long").alias("batch"))


def generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a generator would return for each turn: cited ids of documents, then an answer or the sign that the round ends."""
    turns = table(spark, sf_dir, "conversations")
    n = table(spark, sf_dir, "documents").agg(F.max("doc_id").alias("most"))
    a, b = (F.col("conv_id") * m + F.col("turn") for m in (7, 3))
    cited = F.concat(F.lit("["), (a % (F.col("most") + 1)).cast("string"), F.lit("]. foo["), (b % 5000).cast("string"), F.lit("] [x] ["), (a % (F.col("most") + 1)).cast("string"), F.lit("]"))
    rest = F.when(F.col("turn") % 2 == 0, F.concat(F.lit(f"{text.ANCHOR} on\n{text.ANSWER} "), F.col("text"), F.lit(f" {text.END} rest"))).otherwise(F.lit(f" {text.OBJECT_END}"))
    return turns.crossJoin(F.broadcast(n)).select("conv_id", "turn", F.col("text").alias("said"), F.concat(cited, rest).alias("out"))


GENERATED = """
    SELECT conv_id, turn, text AS said,
           '[' || (conv_id * 7 + turn) % (most + 1) || ']. foo[' || (conv_id * 3 + turn) % 5000 || '] [x] [' || (conv_id * 7 + turn) % (most + 1) || ']'
           || CASE WHEN turn % 2 = 0 THEN chr(10) || 'Please answer the question based on' || chr(10) || 'The answer to the question is: ' || text || ' <|im_end|> rest'
              ELSE ' <|object_ref_end|>' END AS out
    FROM conversations, (SELECT max(doc_id) AS most FROM documents)
"""


def answer_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = generated(spark, sf_dir)
    return rows.select("conv_id", "turn", text.answer_of(F.col("out")).alias("answer"), text.after_anchor(F.col("out")).alias("anchored"))


def regenerate_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = generated(spark, sf_dir).where(text.must_regenerate(F.col("out")))
    return rows.select("conv_id", "turn", F.concat(F.lit(text.REGENERATE), "out").alias("prompt"))


def cited_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = generated(spark, sf_dir).select("conv_id", "turn", F.explode(text.cited_ids(F.col("out"))).alias("doc_id"))
    return rows.join(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", "left_semi")


def inject_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cited documents, composed and joined in order of id; ids that the corpus lacks are dropped."""
    cites = generated(spark, sf_dir).select("conv_id", "turn", F.explode(text.cited_ids(F.col("out"))).alias("doc_id"))
    found = cites.join(compose_documents(spark, sf_dir), "doc_id")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "composed"))), lambda x: x["composed"]), "\n")
    return found.groupBy("conv_id", "turn").agg(F.count("*").alias("n_docs"), F.sha2(joined, 256).alias("context_sha256"))


def response_fanin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of each conversation joined in order, with whether none is missing."""
    turns = table(spark, sf_dir, "conversations")
    parts = F.array_sort(F.collect_list(F.struct("turn", "text")))
    whole = F.array_join(F.transform(parts, lambda x: x["text"]), "|")
    return turns.groupBy("conv_id").agg((F.count("*") == F.max("turn") + 1).alias("complete"), F.sha2(whole, 256).alias("text_sha256"))


def human_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of all magnitudes, said for readers: an odd power of each document's length."""
    size = F.col("n_chars") * F.pow(F.lit(32), F.col("doc_id") % 9).cast("long")
    return table(spark, sf_dir, "documents").select("doc_id", text.human_bytes(size).alias("said"))


def judge_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores read from replies that are made of each turn's length."""
    n = F.length("text") % 12
    reply = F.when(n < 6, F.concat(F.lit("Score: "), n.cast("string"))).when(n < 9, F.concat(n.cast("string"), F.lit(" then 3: mismatch"))).otherwise(F.lit("n/a, a Match"))
    rows = table(spark, sf_dir, "conversations").withColumn("reply", reply)
    return rows.groupBy("role").agg(F.round(F.avg(text.judged(F.col("reply"))), 4).alias("mean_score"), F.sum(text.matches(F.col("reply")).cast("long")).alias("n_match"))


def answer_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies in the forms that models give, and what a judge sees of them."""
    kind, t = F.col("turn") % 4, F.col("text")
    said = F.when(kind == 0, F.concat(F.lit("<think>x</think> <answer>Answer: "), t, F.lit(" </answer><|im_end|>")))
    said = said.when(kind == 1, F.concat(F.lit("q <answer>The answer to the question is: "), t, F.lit("</answer><|endoftext|>")))
    said = said.when(kind == 2, F.concat(F.lit("Answer: "), t, F.lit(" Answer: other"))).otherwise(F.concat(F.lit("<think>y</think>The user's question is:"), t))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", text.cleaned(said).alias("answer"))


def round_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rounds and which retrievals are over, by what each turn has said so far."""
    kind = F.col("conv_id") % 5
    cited = F.regexp_substr("out", F.lit(r"\[\d+"))
    inner = F.when(kind == 0, cited).when(kind == 1, F.concat(cited, F.lit("]"))).when(kind == 2, F.left(F.lit("<End-of-Retrieve>"), F.length("said") % 17)).when(kind == 3, F.concat("said", F.lit("<End-of-Retrieve>"))).otherwise(F.col("out"))
    first = F.col("turn") == 0
    return generated(spark, sf_dir).select("conv_id", "turn", text.round_ended(inner, first).alias("round_over"), text.retrieval_ended(inner, first, 80).alias("retrieval_over"))


def block_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as blocks of documents, with the template's head: tokens and positions of each document and role."""
    head, _ = prompts.template_split(F.lit(f"{PREFIX}<pad>{SUFFIX}"), "<pad>")
    docs = table(spark, sf_dir, "conversations").select("conv_id", "turn", text.tokens(F.col("text")).alias("tokens"))
    rows = prompts.block_tokens(docs, "conv_id", "turn", "tokens", text.tokens(head))
    return rows.groupBy("conv_id", F.coalesce("doc_local", F.lit(0)).alias("doc_local"), "role").agg(F.count("*").alias("n"), F.min("position").alias("first"), F.max("position").alias("last"), F.sum(F.length("token")).alias("n_chars"))


def regenerate_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts of a later round, made of each turn's text, and their tokens' roles by first letters."""
    t, turn = F.col("text"), F.col("turn")
    asked = F.when(turn % 2 == 0, F.lit(f" {text.REQUEST}")).otherwise("")
    rest = F.when(turn % 3 == 0, F.lit(f" more{text.OBJECT_END}")).otherwise("")
    prompt = F.concat(F.lit(text.REGENERATE), t, asked, F.lit(f"\n[3]{text.OBJECT_END}[4]. "), t, F.lit(f"]{text.OBJECT_END}[5]"), rest)
    said, roles = prompts.regenerate_roles(prompt)
    letters = F.array_join(F.transform(roles, lambda r: F.substring(r, 1, 1)), "")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.sha2(said, 256).alias("said_sha256"), letters.alias("roles"))


def query_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = prompts.query_positions(text.tokens(F.col("text")), 16)
    return table(spark, sf_dir, "benchmark").select("item_id", F.array_join(F.transform(places, lambda p: p.cast("string")), ",").alias("positions"))


def encode_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pooled keys, values and router keys of every document, by the stand-in encoder."""
    docs = table(spark, sf_dir, "documents").select("doc_id", text.tokens(F.col("text")).alias("tokens"))
    rows = hooks.encoded(docs, hooks.running_means, 64)
    return rows.select("doc_id", "chunk", *[F.round(F.col(c)[i], 6).alias(f"{c}{i}") for c in ("k", "v", "rk") for i in (0, 1)])


def letters() -> Callable[[list], list[str]]:
    """A stand-in decoder: a letter for each id."""
    return lambda rows: ["".join(chr(96 + min(int(i), 26)) for i in ids) for ids in rows]


def response_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as lengths of words, decoded."""
    ids = F.transform(text.tokens(F.col("text")), lambda w: F.length(w).cast("long"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", hooks.decoded(ids, letters).alias("decoded"))


def judge_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stand-in judge's score of answers that are the first fifths of each turn's words."""
    words = text.tokens(F.col("text"))
    some = F.floor(F.size(words) * (F.col("turn") % 5 + 1) / 5).cast("int")
    said = F.concat(F.lit("Answer: "), F.array_join(F.slice(words, 1, some), " "))
    rows = table(spark, sf_dir, "conversations").withColumn("said", said)
    return hooks.scored(rows, hooks.overlap_judge, "role", "text", "said").select("conv_id", "turn", "pred_score")


def result_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn's citations against the first of them, with the cited texts where all are known."""
    rows = generated(spark, sf_dir).select(F.struct("conv_id", "turn").alias("key"), text.cited_ids(F.col("out")).alias("predictions"), F.array(F.regexp_extract("out", r"^\[(\d+)\]", 1).cast("long")).alias("labels"))
    found = metrics.result_records(rows, table(spark, sf_dir, "documents"), "key")
    context = F.sha2(F.array_join("predictions_text", "\n"), 256)
    return found.select("key.*", F.col("labels_text").isNotNull().alias("recorded"), context.alias("context_sha256"), *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1", "iou")])


def context_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Template, chunks and question of each conversation, one behind the other."""
    n = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sum(text.chunk_count(text.token_count(F.col("text")), 64)).alias("n"))
    return n.select("conv_id", *[c.alias(k) for k, c in prompts.context_offsets(text.token_count(F.lit(PREFIX)), F.col("n")).items()])


def label_text_to_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each distinct text's document; of several the largest id."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))
    return docs.groupBy("digest").agg(F.max("doc_id").alias("doc_id"), F.count("*").alias("n_docs"))


def anti_distractor_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus with two copies of every document that isn't a label's; labels are those of quality 1."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    wanted = docs.join(good, "doc_id", "left_semi").select("digest").distinct()
    copies = docs.join(wanted, "digest", "left_anti").crossJoin(F.broadcast(spark.range(1, 3).withColumnRenamed("id", "copy")))
    both = docs.withColumn("copy", F.lit(0).cast("long")).unionByName(copies)
    return both.groupBy("copy").agg(F.count("*").alias("n_docs"), F.countDistinct("digest").alias("n_texts"))


def label_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled texts, every third a little different, looked up in the corpus."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    said = docs.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi").withColumnRenamed("doc_id", "asked")
    label = F.when(F.col("asked") % 3 == 0, F.concat("text", F.lit("?"))).otherwise(F.col("text"))
    return corpora.ids_of(said.select("asked", label.alias("label")), docs).select("asked", "doc_id")


def scaled_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus with two rounds of copies of texts that aren't those of quality 1."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    good = docs.join(table(spark, sf_dir, "labels").where("quality = 1").select("doc_id"), "doc_id", "left_semi")
    return corpora.scaled(docs, good, 2).select("doc_id", F.sha2("text", 256).alias("text_sha256"))


def block_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as packed blocks; what each token sees, as a first place, instead of a mask."""
    head, _ = prompts.template_split(F.lit(f"{PREFIX}<pad>{SUFFIX}"), "<pad>")
    docs = table(spark, sf_dir, "conversations").select("conv_id", "turn", text.tokens(F.col("text")).alias("tokens"))
    packed = prompts.block_arrays(prompts.block_tokens(docs, "conv_id", "turn", "tokens", text.tokens(head)), "conv_id")
    said = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    packed = packed.withColumn("seen", prompts.seen_from(F.col("starts"), F.size("tokens")))
    return packed.select("conv_id", F.sha2(F.array_join("tokens", " "), 256).alias("tokens_sha256"), said(F.col("positions")).alias("positions"), said(F.col("starts")).alias("starts"), said(F.col("seen")).alias("seen_from"))


def context_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Template, turns and question of each conversation, in that order."""
    turns = table(spark, sf_dir, "conversations")
    part = lambda df, kind, pos, t: df.select("conv_id", F.lit(kind).alias("kind"), F.lit(pos).cast("long").alias("pos") if isinstance(pos, int) else pos.alias("pos"), t.alias("part"))
    ids = turns.select("conv_id").distinct()
    union = part(ids, 0, 0, F.lit(PREFIX)).unionByName(part(turns, 1, F.col("turn"), F.col("text"))).unionByName(part(ids, 2, 0, F.lit(SUFFIX)))
    ordered = F.array_sort(F.collect_list(F.struct("kind", "pos", "part")))
    return union.groupBy("conv_id").agg(F.sha2(F.array_join(F.transform(ordered, lambda x: x["part"]), ""), 256).alias("context_sha256"))


QUERIES = {f.__name__: f for f in (compose_documents, chunk_counts, corpus_stats, query_template, sort_requests, answer_extract, regenerate_filter, cited_ids, inject_docs, response_fanin, judge_parse, human_bytes, answer_clean, round_flags, block_positions, regenerate_roles, query_positions, encode_chunks, response_decode, judge_score, result_records, context_offsets, label_text_to_id, label_lookup, scaled_corpus, block_arrays, anti_distractor_scale, context_union)}
COUNTS = r"SELECT doc_id, len(regexp_extract_all(text, '\S+'))::BIGINT AS n_tokens, ((len(regexp_extract_all(text, '\S+')) + 63) // 64)::BIGINT AS n_chunks FROM documents"
CITES = f"SELECT DISTINCT conv_id, turn, unnest(regexp_extract_all(out, '\\[(\\d+)\\]', 1))::BIGINT AS doc_id FROM ({GENERATED})"
COMPOSED = "SELECT doc_id, '<|im_start|>[' || doc_id || ']. ' || text || '[' || doc_id || ']<|im_end|>' AS composed FROM documents"
ORACLE_SQL = {
    "compose_documents": COMPOSED,
    "chunk_counts": COUNTS,
    "corpus_stats": f"SELECT doc_id % 8 AS bucket, count(*)::BIGINT AS n_docs, sum(n_tokens)::BIGINT AS n_tokens, sum(n_chunks)::BIGINT AS n_chunks FROM ({COUNTS}) GROUP BY 1",
    "query_template": r"""SELECT item_id, '<|im_start|>user' || chr(10) || text || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) AS prompt,
        repeat('query,', (len(regexp_extract_all(text, '\S+')) + 1)::INTEGER) || 'template,template,response' AS roles, (len(regexp_extract_all(text, '\S+')) + 18)::BIGINT AS last_position FROM benchmark""",
    "sort_requests": "SELECT doc_id, turn, turn // 64 AS batch FROM (SELECT doc_id, row_number() OVER (ORDER BY length(text) NULLS FIRST, doc_id) - 1 AS turn FROM documents)",
    "answer_extract": f"""
        SELECT conv_id, turn, trim(CASE WHEN turn % 2 = 0 THEN ' ' || string_split(said, '<|im_end|>')[1] ELSE string_split(out, '<|im_end|>')[1] END, ' ') AS answer,
               CASE WHEN instr(out, chr(10) || 'Please answer the question based') > 0 THEN substr(out, instr(out, chr(10) || 'Please answer the question based')) END AS anchored
        FROM ({GENERATED})""",
    "regenerate_filter": f"SELECT conv_id, turn, '<regenerate>' || out AS prompt FROM ({GENERATED}) WHERE rtrim(out, ' ') LIKE '%<|object_ref_end|>' AND NOT contains(out, 'The answer to the question is:')",
    "cited_ids": f"SELECT conv_id, turn, doc_id FROM ({CITES}) WHERE doc_id IN (SELECT doc_id FROM documents)",
    "inject_docs": f"""
        SELECT conv_id, turn, count(*)::BIGINT AS n_docs, sha256(string_agg(composed, chr(10) ORDER BY doc_id)) AS context_sha256
        FROM ({CITES}) JOIN ({COMPOSED}) USING (doc_id) GROUP BY conv_id, turn""",
    "response_fanin": "SELECT conv_id, count(*) = max(turn) + 1 AS complete, sha256(string_agg(text, '|' ORDER BY turn)) AS text_sha256 FROM conversations GROUP BY conv_id",
    "human_bytes": """
        WITH s AS (SELECT doc_id, n_chars * (32 ** (doc_id % 9))::BIGINT AS n FROM documents)
        SELECT doc_id, CASE WHEN n IS NULL OR n < 1 THEN '0B' WHEN n < 1024 THEN n || 'B' WHEN n < 1024 ** 2 THEN round_even(n / 1024, 0)::BIGINT || 'K'
               WHEN n < 1024 ** 3 THEN round_even(n / 1024 ** 2, 0)::BIGINT || 'M' WHEN n < 1024 ** 4 THEN format('{:.1f}G', n / 1024 ** 3)
               WHEN n < 1024 ** 5 THEN format('{:.1f}T', n / 1024 ** 4) ELSE format('{:.1f}P', n / 1024 ** 5) END AS said FROM s""",
    "judge_parse": """
        WITH r AS (SELECT role, length(text) % 12 AS n FROM conversations)
        SELECT role, round(avg(CASE WHEN n < 6 THEN n WHEN n < 9 THEN 3 ELSE 0 END), 4) AS mean_score, count(*) FILTER (WHERE n >= 9)::BIGINT AS n_match FROM r GROUP BY role""",
    "answer_clean": """
        WITH said AS (SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN '<think>x</think> <answer>Answer: ' || text || ' </answer><|im_end|>'
                WHEN 1 THEN 'q <answer>The answer to the question is: ' || text || '</answer><|endoftext|>'
                WHEN 2 THEN 'Answer: ' || text || ' Answer: other' ELSE '<think>y</think>The user''s question is:' || text END AS s FROM conversations),
        qa AS (SELECT conv_id, turn, string_split(replace(replace(s, '<|im_end|>', ''), '<|endoftext|>', ''), '<answer>')[-1] AS s FROM said),
        a AS (SELECT conv_id, turn, string_split(replace(replace(string_split(s, 'The answer to the question is: ')[-1], '</answer>', ''), 'The user''s question is:', ''), '</think>')[-1] AS s FROM qa)
        SELECT conv_id, turn, CASE WHEN contains(s, 'Answer:') THEN trim(string_split(s, 'Answer:')[2], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) ELSE s END AS answer FROM a""",
    "round_flags": f"""
        WITH r AS (SELECT conv_id, turn, CASE conv_id % 5 WHEN 0 THEN regexp_extract(out, '\\[[0-9]+') WHEN 1 THEN regexp_extract(out, '\\[[0-9]+') || ']'
                          WHEN 2 THEN left('<End-of-Retrieve>', length(said) % 17) WHEN 3 THEN said || '<End-of-Retrieve>' ELSE out END AS s FROM ({GENERATED}))
        SELECT conv_id, turn, contains(s, '<|object_ref_end|>') OR (turn > 0 AND NOT regexp_full_match(s, '\\[[0-9]*\\]?') AND NOT starts_with('<End-of-Retrieve>', s)) AS round_over,
               contains(s, '<End-of-Retrieve>') OR (turn = 0 AND length(s) > 80) AS retrieval_over FROM r""",
    "block_positions": r"""
        WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS doc_local, regexp_extract_all(text, '\S+') AS w FROM conversations)
        SELECT conv_id, doc_local, 'document' AS role, len(w)::BIGINT AS n, 0::BIGINT AS first, (len(w) - 1)::BIGINT AS last, length(array_to_string(w, ''))::BIGINT AS n_chars FROM t WHERE len(w) > 0
        UNION ALL SELECT DISTINCT conv_id, 0, 'template', 1, 0, 0, 16 FROM conversations""",
    "context_offsets": r"""
        SELECT conv_id, 1::BIGINT AS chunks_at, (1 + sum((len(regexp_extract_all(text, '\S+')) + 63) // 64))::BIGINT AS question_at FROM conversations GROUP BY conv_id""",
    "regenerate_roles": r"""
        WITH p AS (SELECT conv_id, turn, text || CASE WHEN turn % 2 = 0 THEN ' Please return all documents related to the question' ELSE '' END || chr(10) || '[3]<|object_ref_end|>[4]. '
                || text || ']<|object_ref_end|>[5]' || CASE WHEN turn % 3 = 0 THEN ' more<|object_ref_end|>' ELSE '' END AS s FROM conversations),
        t AS (SELECT *, '[' || string_split(s, ']<|object_ref_end|>[')[-1] AS tail, string_split(s, 'Please return all documents related to the question') AS asked FROM p),
        n AS (SELECT *, len(regexp_extract_all(left(s, length(s) - length(tail)), '\S+')) AS a,
                CASE WHEN contains(tail, '<|object_ref_end|>') THEN len(regexp_extract_all(string_split(tail, '<|object_ref_end|>')[1], '\S+')) ELSE 0 END AS b,
                CASE WHEN len(asked) > 1 THEN len(regexp_extract_all(asked[1] || 'Please return all documents related to the question', '\S+')) ELSE 0 END AS h FROM t)
        SELECT conv_id, turn, sha256(s) AS said_sha256,
               array_to_string(list_transform(range(len(regexp_extract_all(s, '\S+'))), lambda i: CASE WHEN i < h OR (i >= a AND i < a + b) THEN 't' ELSE 'q' END), '') AS roles FROM n""",
    "query_positions": r"SELECT item_id, array_to_string(list_transform(range(len(regexp_extract_all(text, '\S+'))), lambda i: i + 19), ',') AS positions FROM benchmark",
    "encode_chunks": r"""
        WITH w AS (SELECT doc_id, regexp_extract_all(text, '\S+') AS w FROM documents),
        x AS (SELECT doc_id, i - 1 AS pos, length(w[i])::DOUBLE AS a, unicode(w[i])::DOUBLE AS b FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM w)),
        k AS (SELECT *, avg(a) OVER m AS ka, avg(b) OVER m AS kb FROM x WINDOW m AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
        SELECT doc_id, pos // 64 AS chunk, round(avg(ka), 6) AS k0, round(avg(kb), 6) AS k1, round(avg(a), 6) AS v0, round(avg(b), 6) AS v1, round(avg(kb), 6) AS rk0, round(avg(ka), 6) AS rk1
        FROM k GROUP BY ALL""",
    "response_decode": r"SELECT conv_id, turn, array_to_string(list_transform(regexp_extract_all(text, '\S+'), lambda w: chr((96 + least(length(w), 26))::INT)), '') AS decoded FROM conversations",
    "judge_score": r"""
        WITH w AS (SELECT conv_id, turn, list_distinct(list_filter(string_split(text, ' '), lambda x: x <> '')) AS a, regexp_extract_all(text, '\S+') AS w FROM conversations),
        b AS (SELECT *, list_distinct(w[1:(len(w) * (turn % 5 + 1)) // 5]) AS b FROM w)
        SELECT conv_id, turn, (10 * len(list_intersect(a, b)) // greatest(1, len(a) + len(b)))::BIGINT AS pred_score FROM b""",
    "result_records": f"""
        WITH t AS (SELECT conv_id, turn, count(*) AS n, count(known) AS m, string_agg(text, chr(10) ORDER BY doc_id) AS whole
                   FROM ({CITES}) LEFT JOIN (SELECT doc_id, text, 1 AS known FROM documents) USING (doc_id) GROUP BY conv_id, turn)
        SELECT conv_id, turn, n = m AS recorded, CASE WHEN n = m THEN sha256(whole) END AS context_sha256, round(1.0::DOUBLE / n, 6) AS precision, 1.0::DOUBLE AS recall,
               round(2.0::DOUBLE / (n + 1), 6) AS f1, round(1.0::DOUBLE / n, 6) AS iou FROM t""",
    "label_text_to_id": "SELECT sha256(text) AS digest, max(doc_id) AS doc_id, count(*)::BIGINT AS n_docs FROM documents GROUP BY text",
    "anti_distractor_scale": """
        WITH wanted AS (SELECT DISTINCT text FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
        both_ AS (SELECT text, 0::BIGINT AS copy FROM documents UNION ALL
                  SELECT text, c FROM documents, range(1, 3) r(c) WHERE text NOT IN (SELECT text FROM wanted))
        SELECT copy, count(*)::BIGINT AS n_docs, count(DISTINCT text)::BIGINT AS n_texts FROM both_ GROUP BY copy""",
    "label_lookup": """
        SELECT l.doc_id AS asked, max(d.doc_id) AS doc_id
        FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN text || '?' ELSE text END AS label FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)) l LEFT JOIN documents d ON d.text = l.label GROUP BY l.doc_id""",
    "scaled_corpus": """
        WITH places AS (SELECT text, row_number() OVER (ORDER BY doc_id) - 1 AS place, count(*) OVER () AS n FROM documents),
        copies AS (SELECT text, r * n + place AS bias, n FROM places, range(2) q(r) WHERE text NOT IN (SELECT text FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)))
        SELECT place AS doc_id, sha256(text) AS text_sha256 FROM places
        UNION ALL SELECT n + row_number() OVER (ORDER BY bias) - 1, sha256(text || '_copy' || bias) FROM copies""",
    "block_arrays": r"""
        WITH t AS (SELECT conv_id, turn + 1 AS seg, regexp_extract_all(text, '\S+') AS w FROM conversations UNION ALL SELECT DISTINCT conv_id, 0, ['<|im_start|>user'] FROM conversations),
        s AS (SELECT *, coalesce(sum(len(w)) OVER (PARTITION BY conv_id ORDER BY seg ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM t WHERE len(w) > 0)
        SELECT conv_id, sha256(string_agg(array_to_string(w, ' '), ' ' ORDER BY seg)) AS tokens_sha256, string_agg(array_to_string(range(len(w)), ','), ',' ORDER BY seg) AS positions,
               string_agg(start, ',' ORDER BY seg) AS starts, string_agg(array_to_string(list_transform(w, lambda x: start), ','), ',' ORDER BY seg) AS seen_from FROM s GROUP BY conv_id""",
    "context_union": """
        SELECT conv_id, sha256('<|im_start|>user' || chr(10) || string_agg(text, '' ORDER BY turn) || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10)) AS context_sha256
        FROM conversations GROUP BY conv_id""",
}
