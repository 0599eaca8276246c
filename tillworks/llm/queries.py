"""Registered queries of this folder: each applies its operator to a whole table and derives the columns of its contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillworks.functions.skew import join_per_key
from tillworks.llm import (chat, collocations, conversation_repair, decontamination, language_bitmask, licenses, mixing, pieces,
                           quality_discriminant, quality_rules, secrets, sentence_dedup, set_join)
from tillworks.llm.text import is_training
from tillworks.session import cut_lineage
from tillworks.sources.tables import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return add


WORDS_SQL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query("op2_winnowing", f"""
WITH d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
b AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS t
       FROM b, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS u(i) WHERE len(w) > 0),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS t
       FROM d, (SELECT DISTINCT n FROM bw) AS s, unnest(range(1, len(w) - n + 2)) AS u(i) WHERE len(w) >= n),
hits AS (SELECT doc_id, item_id, i, n FROM dw JOIN bw USING (n, t)),
cover AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM hits, unnest(range(i, i + n)) AS u(j) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) AS x GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN found USING (doc_id)""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontamination.benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.select(F.col("id").alias("doc_id"), F.col("n_words").cast("long"), F.col("n_hit").cast("long"),
                       F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                       decontamination.is_contaminated().alias("contaminated"))


@query("op3_decision_list")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = quality_rules.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    stats = F.col(rows.columns[-1])
    return rows.select("doc_id", *[stats[c].alias(c) for c in [*quality_rules.BASE, "base_failed", "kept"]])


def domain_of(source: str = "source"):
    """Example domains: by the last digits of the source's name."""
    number = F.regexp_extract(F.coalesce(F.col(source), F.lit("")), "([0-9]{1,9})$", 1)
    names = F.array(*[F.lit(x) for x in ("web", "books", "code", "forums")])
    return F.when(number == "", F.lit("other")).otherwise(F.get(names, F.try_to_number(number, F.lit("999999999")).cast("int") % 4))


def mix_levels() -> dict:
    return {"mix_domain": domain_of(), "mix_lang": F.col("lang"), "mix_source": F.col("source")}


def mix_weights() -> list:
    return [mixing.weight_of("mix_domain", {"web": 5, "books": 3, "code": 2, "forums": 1}, 1),
            mixing.weight_of("mix_lang", {"en": 6, "de": 2, "fr": 2, "es": 2}, 1), F.col("tokens")]


MIX_OPTIONS = {"budget_share": 0.5, "max_epochs": 2, "seed": 17}


def _share_sql(name: str, source: str, parents: list[str], own: str, weight: str, budget: str) -> str:
    """One level of the budget: limits, weights and the filled-up shares."""
    keys = [*parents, own]
    part = f"PARTITION BY {', '.join(parents)}" if parents else ""
    above = "" if not parents else f" JOIN {budget} AS p ON " + " AND ".join(f"x.{c} IS NOT DISTINCT FROM p.{c}" for c in parents)
    money = "p.target" if parents else "(SELECT CAST(floor(coalesce(sum(tokens), 0)::DOUBLE * 0.5) AS BIGINT) FROM tree)"
    order = f"ORDER BY lim::DOUBLE / weight::DOUBLE NULLS FIRST, {own} NULLS FIRST"
    return f"""{name}n AS (SELECT x.*, {money} AS budget FROM (SELECT {', '.join(keys)}, sum(tokens)::BIGINT AS tokens, (2 * sum(tokens))::BIGINT AS lim,
  CAST({weight} AS BIGINT) AS weight FROM {source} GROUP BY {', '.join(keys)}) AS x{above}),
{name}r AS (SELECT *, (budget - coalesce(sum(lim) OVER ({part} {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
  / (sum(weight) OVER ({part} {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS rate FROM {name}n WHERE weight > 0),
{name} AS (SELECT *, least(lim, greatest(0, CAST(floor(max(rate) OVER ({part}) * weight) AS BIGINT)))::BIGINT AS target FROM {name}r)"""


MIX_SQL = rf"""
WITH docs AS (SELECT doc_id, lang, source, CAST(doc_id AS VARCHAR) AS id,
  CASE WHEN regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1) = '' THEN 'other'
       ELSE ['web', 'books', 'code', 'forums'][CAST(regexp_extract(source, '([0-9]{{1,9}})$', 1) AS BIGINT) % 4 + 1] END AS domain,
  len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> ''))::BIGINT AS tokens FROM documents),
tree AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS tokens FROM docs GROUP BY ALL HAVING sum(tokens) > 0),
{_share_sql("a", "tree", [], "domain", "CASE domain WHEN 'web' THEN 5 WHEN 'books' THEN 3 WHEN 'code' THEN 2 WHEN 'forums' THEN 1 ELSE 1 END", "")},
{_share_sql("b", "tree", ["domain"], "lang", "CASE lang WHEN 'en' THEN 6 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 WHEN 'es' THEN 2 ELSE 1 END", "a")},
{_share_sql("c", "tree", ["domain", "lang"], "source", "sum(tokens)", "b")},
plan AS (SELECT domain, lang, source, target // tokens AS epochs, target % tokens AS rest FROM c),
leaf AS (SELECT d.*, p.epochs, p.rest, md5('17:' || p.epochs || ':' || d.id) AS place FROM docs AS d JOIN plan AS p
  ON d.domain = p.domain AND d.lang IS NOT DISTINCT FROM p.lang AND d.source IS NOT DISTINCT FROM p.source WHERE d.tokens > 0),
run AS (SELECT *, coalesce(sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM leaf)
SELECT doc_id, domain, lang, source, tokens, epochs::BIGINT AS epochs, least(tokens, greatest(0, rest - before))::BIGINT AS part_tokens
FROM run WHERE epochs > 0 OR rest > before"""


@query("op5_hierarchical_mix", MIX_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, levels = table(spark, sf_dir, "documents"), mix_levels()
    rows = cut_lineage(docs.select("doc_id", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                                          F.xxhash64("text").alias("text_key"), *[c.alias(n) for n, c in levels.items()],
                                          mixing.token_count().alias("tokens")))
    plan = mixing.plan_mixture(rows, list(levels), mix_weights(), **MIX_OPTIONS)
    out = mixing.shares(rows, plan, list(levels), "tokens", "id", "text_key", MIX_OPTIONS["seed"])
    return out.select("doc_id", F.col("mix_domain").alias("domain"), F.col("mix_lang").alias("lang"), F.col("mix_source").alias("source"),
                      "tokens", F.col("epochs").cast("long"), "part_tokens")


@query("op7_sentence_rules", licenses.oracle_sql())
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licences(table(spark, sf_dir, "documents"))


@query("op8_chosen_path")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = set_join.jaccard_classes(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.col("first_id").alias("class_id"), "copies", "n_links")


@query("op10_worklist")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["base"])

    def count(kind):
        return F.size(F.filter("spans", lambda x: x["base"] & (x["kind"] == kind))).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in secrets.KINDS], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), "complete")


@query("op1_bitmask_filters")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_bitmask.learn(docs.where(is_training("doc_id")))
    told = language_bitmask.identify(docs, model)
    return told.select("doc_id", (~is_training("doc_id")).alias("held_out"), "lang_pred", "score")


@query("op4_quadratic_discriminant")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = cut_lineage(quality_discriminant.with_vectors(table(spark, sf_dir, "documents")))
    labels = table(spark, sf_dir, "labels").where(F.col("quality").isin(0, 1) & is_training("doc_id"))
    labels = labels.select(F.col("doc_id").alias("id"), F.col("quality").alias("label")).distinct()
    model = quality_discriminant.learn(vectors.join(labels, "id").select("x", "label"))
    return quality_discriminant.scored(vectors, model).select(
        F.col("id").alias("doc_id"), (~is_training("id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op6_offset_masks")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    planted = spark.createDataFrame([(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")], rows.schema)
    return chat.digests(chat.format_conversations(rows.unionByName(planted)))


@query("op9_sentence_spans")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sentence_dedup.without_repeats(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_sentences", "n_removed", "words_removed", F.sha2("text", 256).alias("text_sha256"))


@query("op11_lightest_derivation")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    found, turns = conversation_repair.repair(conversation_repair.damaged(rows))
    ids = rows.select(F.col("conv_id").alias("conv")).distinct()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    for part in (found, conversation_repair.turn_digests(turns)):
        ids = join_per_key(ids, part, ["conv"])
    return ids.select(F.col("conv").alias("conv_id"), *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in numbers],
                      F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


@query("op12_direct_address_tiling", collocations.oracle_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query("op13_distinct_chunks")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = pieces.read_model(pieces.MODEL)
    docs = pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), model)
    docs = pieces.decode(docs.select("doc_id", "token_ids"), model)
    return docs.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
