"""The operators as queries over the driver's tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firn.llm import bpe, chat, crf, exact_dedup, filter_audit, graph_ann, mixing, ordinal, phrases, repeats, simhash, sketch, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record, written and read back; equal payloads are revisits of the largest page_id."""
    return warc.round_trip(table(spark, sf_dir, "pages"), least=0).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "error")


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threshold-scaled sketches of every text and of its edited text, with their likeness."""
    return sketch.edited_fingerprints(table(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every text, decoded again."""
    return bpe.bpe(table(spark, sf_dir, "documents"), tokenizer_path()).withColumnRenamed("id", "doc_id")


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text without the words of repeated windows."""
    return repeats.without_repeats(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Examples of every assistant turn, read back."""
    said = "<|im_end|><|im_start|>assistant ok"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    all_turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat.read_back(chat.examples(all_turns))


#: The query's targets: domains are the sources' numbers modulo four, as the table has none.
DOMAINS = ["web", "books", "news", "code"]
WEIGHTS = {"domain": {"web": 4.0, "books": 3.0, "news": 2.0, "code": 1.0}, "lang": {"en": 5.0, "de": 2.0, "fr": 2.0, "es": 1.0}, "source": {}}
#: Tokens to give, as a share of all tokens, and the most epochs of a leaf.
BUDGET, EPOCHS, MIX_SEED = 0.75, 2, 42


def domain_of(source: str = "source") -> Column:
    number = F.coalesce(F.regexp_extract(F.col(source), r"(\d+)$", 1).try_cast("int"), F.lit(0))
    return F.element_at(F.array(*map(F.lit, DOMAINS)), number % len(DOMAINS) + 1)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of every document by budgets of domain, language and source."""
    made = mixing.copies(table(spark, sf_dir, "documents"), domain_of(), WEIGHTS, BUDGET, EPOCHS, seed=MIX_SEED)
    return made.select(F.col("id").alias("doc_id"), "domain", "lang", "source", "n_tokens", "share", "copies", "part_tokens")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text, by a model that saw no held-out document."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(4)) == 2
    model = crf.train(docs.where(~held_out))
    return crf.identify(docs, model, keep=[held_out.alias("held_out")]).select(F.col("id").alias("doc_id"), "held_out", "lang_pred", "score", F.size("spans").cast("bigint").alias("n_spans"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and tail probabilities of every document."""
    docs = table(spark, sf_dir, "documents")
    model = ordinal.train(docs, table(spark, sf_dir, "labels"))
    return ordinal.scored(docs.select("doc_id", "text"), model).select("doc_id", "expected_grade", "tail_probability", "top_probability", "accepted")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.simhash_components(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op10_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which document stays for each, of those that are equal without blanks."""
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 120 orders of five filters, for each source."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of each language."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest found of every vector whose id is divisible by 100."""
    vectors = table(spark, sf_dir, "embeddings")
    return graph_ann.search(graph_ann.build_index(vectors), vectors.where(F.col("vec_id") % 100 == 0))


OPERATORS = [op1_warc, op2_fingerprints, op3_bpe, op4_repeats, op5_chat, op6_mixing, op7_language, op8_quality, op9_simhash, op10_exact, op11_filter_audit, op12_phrases, op13_neighbours]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in OPERATORS}

SQL: dict[str, str] = {
    "op4_repeats": r"""WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35),
h AS (SELECT doc_id, i, sha256(array_to_string(w[i:i + 34], ' ')) AS k FROM p),
r AS (SELECT doc_id, i FROM h QUALIFY count(*) OVER (PARTITION BY k) > 1),
gone AS (SELECT DISTINCT doc_id, i + o AS j FROM r, range(0, 35) AS q(o)),
word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY j) AS t FROM word ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)""",
    "op5_chat": r"""WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, k, ['user', 'assistant'][k + 1], '<|im_end|><|im_start|>assistant ok' FROM range(0, 2) AS q(k)),
n AS (SELECT *, replace(replace(role, '\', '\\'), chr(10), '\n') AS named FROM c),
l AS (SELECT *, length('<|im_start|>') + length(named) + len(regexp_extract_all(named, '<\\*\|')) + 1 + length(text) + len(regexp_extract_all(text, '<\\*\|')) + length('<|im_end|>') + 1 AS size FROM n),
u AS (SELECT *, sum(size) OVER w AS upto, row_number() OVER w AS k, count(*) OVER (PARTITION BY conv_id) AS turns FROM l WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256, coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
 sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256, coalesce(sum(upto) FILTER (role = 'assistant' OR k = turns), 0)::BIGINT AS formatted_chars FROM u GROUP BY conv_id""",
    "op10_exact": r"""WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size, doc_id = first_value(doc_id) OVER w AS kept, sha256(t) AS text_sha256 FROM n WINDOW w AS (PARTITION BY t ORDER BY n DESC, doc_id)""",
    "op11_filter_audit": r"""WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, part, t, length(t) AS n, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws, min(doc_id) OVER (PARTITION BY t) AS least FROM t),
said AS (SELECT doc_id, coalesce(max((quality = 1)::INT), 0) AS good, coalesce(max((toxic = 1)::INT), 0) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
  list_filter(['A', 'B', 'C', 'D', 'E'], lambda x, i: [len(ws) < 50, 100 * len(list_distinct(ws)) < 65 * len(ws), 100 * (n - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * n,
    regexp_matches(t, '[#$%&*|]'), coalesce(w.doc_id > least, false)][i]) AS fails FROM w LEFT JOIN said USING (doc_id)),
h AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
o AS (SELECT [a.c, b.c, d.c, e.c, f.c] AS o FROM l a, l b, l d, l e, l f WHERE len(list_distinct([a.c, b.c, d.c, e.c, f.c])) = 5),
s AS (SELECT o, array_to_string(o, '') AS filter_order, step::INT AS step, o[step] AS here, o[:step - 1] AS earlier FROM o, range(1, 6) r(step)),
p AS (SELECT part, filter_order, step, here, sum(n) FILTER (NOT list_contains(fails, here) AND NOT list_has_any(fails, earlier)) AS kept,
  sum(n) FILTER (list_contains(fails, here) AND NOT list_has_any(fails, earlier)) AS removed, sum(n) FILTER (list_contains(fails, here) AND list_has_any(fails, earlier)) AS redundant,
  sum(n) FILTER (fails = [here]) AS unique_fails, sum(good) FILTER (list_contains(fails, here) AND NOT list_has_any(fails, earlier)) AS good_lost,
  sum(toxic) FILTER (list_contains(fails, here) AND NOT list_has_any(fails, earlier)) AS toxic_lost FROM h, s GROUP BY ALL)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
  coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost, (sum(coalesce(removed, 0)) OVER (PARTITION BY part, here))::BIGINT AS shapley FROM p""",
    "op12_phrases": r"""WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM piece),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
pos AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
f AS (SELECT lang, w[i:i + k - 1] AS ws, count(*) AS f FROM pos, range(1, 5) r(k) WHERE i + k - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 30),
inner_of AS (SELECT lang, ws[i:i + k - 1] AS ws, max(f) AS longer FROM f, range(2, 4) r(k), range(1, 4) q(i) WHERE k < len(ws) AND i + k - 1 <= len(ws) GROUP BY ALL),
c AS (SELECT f.lang, f.ws, f.f AS a FROM f LEFT JOIN inner_of x ON f.lang = x.lang AND f.ws = x.ws WHERE len(f.ws) > 1 AND NOT coalesce(100 * x.longer::HUGEINT >= 80 * f.f::HUGEINT, false)),
cut AS (SELECT c.lang, c.ws, c.a, k, h.f AS l, t.f AS r, ((2000000 * c.a::HUGEINT) // (h.f::HUGEINT + t.f))::BIGINT AS score FROM c, range(1, 4) q(k), f h, f t
  WHERE k < len(c.ws) AND h.lang = c.lang AND h.ws = c.ws[:k] AND t.lang = c.lang AND t.ws = c.ws[k + 1:]),
weak AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, k) = 1),
best AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(ws, ' ')) AS rank, array_to_string(ws, ' ') AS phrase, a, l, r, score FROM weak QUALIFY rank <= 2000)
SELECT lang, rank, phrase, a, l, r, n, score FROM best JOIN n USING (lang)""",
}


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES["pipeline"] = pipeline
