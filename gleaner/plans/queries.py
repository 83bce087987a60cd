"""Registered queries: each operator on the driver tables, with its DuckDB counterpart."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scoring, text
from ..operators import audio, chain, dedupe, discovery, gates, models, prints, quantiles, relevance, sketches, splitter
from ..sources import container, runlog, settings, storage
from ..sources.runlog import last_by_key
from ..streaming import runlog as stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


RULES = gates.TextRules(
    foreign_script="[ßäöü]",
    foreign_terms=("eaux", "ciónez"),
    target_script="[éèêç]",
    context_terms=("the", "and"),
    exclusions={"INTERVIEW": (" Hashed",), "SPEECH": ("whether", "that"), "NEWS": ("tion", "queça", "Ungö"), "LECTURE": ("Être",)},
)
_B = lambda terms: f"'(^|[^a-z0-9])({terms})([^a-z0-9]|$)'"
_TEXT_CASE = f"""case
  when regexp_matches(text, '[ßäöü]') then 'NON_FOLK'
  when regexp_matches(lower(text), {_B('eaux|ciónez')}) then 'NON_FOLK'
  when not regexp_matches(text, '[éèêç]') and not regexp_matches(lower(text), {_B('the|and')}) then 'NON_FOLK'
  when regexp_matches(lower(text), {_B('hashed')}) then 'INTERVIEW'
  when regexp_matches(lower(text), {_B('whether|that')}) and source <> 'src1' then 'SPEECH'
  when regexp_matches(lower(text), {_B('tion|ungö')}) or contains(text, 'queça') then 'NEWS'
  when regexp_matches(lower(text), {_B('être')}) and source <> 'src1' then 'LECTURE' end"""


@query(f"select doc_id, coalesce(code, 'PASS') as outcome from (select doc_id, {_TEXT_CASE} as code from documents)")
def gate_text_cascade(spark, d):
    code = gates.text_code(F.col("text"), F.col("source") == "src1", RULES)
    return t(spark, d, "documents").select("doc_id", F.coalesce(code, F.lit("PASS")).alias("outcome"))


@query(f"""select case when code is null then 'PASS' else 'REJECT' end as decision, code, count(*) as n from
  (select coalesce({_TEXT_CASE}, case when n_chars / 10.0 > 300 then 'TOO_LONG' when n_chars / 10.0 < 10 then 'TOO_SHORT' end) as code
   from documents where doc_id not in (select doc_id from labels)) group by 1, 2""")
def curation_summary(spark, d):
    """The flagship: unprocessed documents through text and length gates, counted by outcome."""
    log = t(spark, d, "labels").select(F.col("doc_id").alias("recording_id"))
    text_gate = gates.text_code(F.col("text"), F.col("source") == "src1", RULES)
    code = F.coalesce(text_gate, gates.duration_code(F.col("n_chars") / 10.0))
    coded = t(spark, d, "documents").select(F.col("doc_id").alias("recording_id"), code.alias("code"))  # before the join, so that no text is shuffled
    decided = chain.pending(coded, log, log.limit(0)).select("code").withColumn("decision", F.when(F.col("code").isNull(), "PASS").otherwise("REJECT"))
    return decided.groupBy("decision", "code").agg(F.count("*").alias("n"))


@query("""select doc_id, case when n_chars / 10.0 > 300 then 'TOO_LONG' when n_chars > 0 and n_chars / 10.0 < 10 then 'TOO_SHORT' end as code
  from documents""")
def gate_length_bounds(spark, d):
    return t(spark, d, "documents").select("doc_id", gates.duration_code(F.col("n_chars") / 10.0).alias("code"))


@query("""select lang, sum((regexp_matches(text, '[éèêç]'))::int)::bigint as french, sum((regexp_matches(text, '[ßäöü]'))::int)::bigint as german
  from documents group by 1""")
def script_detect(spark, d):
    french, german = (F.count_if(text.has_script(F.col("text"), c)) for c in ("[éèêç]", "[ßäöü]"))
    return t(spark, d, "documents").groupBy("lang").agg(french.alias("french"), german.alias("german"))


@query(f"""select doc_id, case when regexp_matches(lower(text), {_B('hand')}) then 'hand' when regexp_matches(lower(text), {_B('thing')}) then 'thing'
  when regexp_matches(lower(text), {_B('the')}) then 'the' end as term from documents""")
def term_first_match(spark, d):
    return t(spark, d, "documents").select("doc_id", text.first_term(F.lower("text"), ["hand", "thing", "the"]).alias("term"))


_STRIP = r"(^|[^\p{L}\p{N}_])(?:the|and|de)([^\p{L}\p{N}_]|$)"


@query(rf"""select doc_id, trim(regexp_replace(regexp_replace(regexp_replace(text, '{_STRIP}', '\1\2', 'gi'), '{_STRIP}', '\1\2', 'gi'),
  '[ \t\n\r]+', ' ', 'g'), ' ') as cleaned from documents""")
def marker_cleanup(spark, d):
    return t(spark, d, "documents").select("doc_id", text.strip_markers(F.col("text"), ["the", "and", "de"]).alias("cleaned"))


@query("""with w as (select p_partkey, unnest(string_split(p_name || ' ' || upper(p_name) || ' ' || p_type, ' ')) as word,
    generate_subscripts(string_split(p_name || ' ' || upper(p_name) || ' ' || p_type, ' '), 1) - 1 as pos from part)
  select p_partkey, word, pos::int as pos from (select *, row_number() over (partition by p_partkey, lower(trim(word)) order by pos) as n from w
  where trim(word) <> '') where n = 1""")
def keyword_explode_dedupe(spark, d):
    words = F.split(F.concat_ws(" ", "p_name", F.upper("p_name"), "p_type"), " ")
    rows = t(spark, d, "part").select("p_partkey", F.posexplode(words).alias("pos", "word"))
    rows = rows.withColumn("key", F.concat_ws(":", "p_partkey", F.lower(F.trim("word")))).where(F.trim("word") != "")
    return dedupe.first_copies(rows, "key", "pos").select("p_partkey", "word", "pos")


@query("""select p_size, p_brand, p_partkey, row_number() over (partition by p_size order by turn, p_brand)::int as pos from
  (select *, row_number() over (partition by p_size, p_brand order by p_partkey) as turn from part)""")
def variant_interleave(spark, d):
    rows = t(spark, d, "part").select("p_size", "p_brand", "p_partkey")
    return discovery.interleave(rows, "p_brand", "p_partkey", by="p_size")


def _lcs_sql(short: str, long: str) -> str:
    """Length of the longest common subsequence: for each character of the long text a row over the beginnings of the short one."""
    start = f"list_transform(range(len({short}) + 1), lambda i: 0)"
    step = f"""list_transform(range(1, len(r) + 1), lambda j: greatest(r[j],
      coalesce(list_max(list_transform(range(2, j + 1), lambda i: if({short}[i - 1] = ch, r[i - 1] + 1, 0))), 0)))"""
    return f"list_last(list_reduce({long}, lambda r, ch: {step}, {start}))"


_KEYS = ["hand thing", "thereof", "queeux", "schein"]


# The best window of the lowered text for each keyword, and the comparison of their sets of words.
@query(f"""with k as (select item_id, lower(text) as low, unnest({_KEYS!r}) as keyword, unnest(range({len(_KEYS)})) as ord from benchmark),
  c as (select *, string_split(low, '') as t, string_split(keyword, '') as s, len(keyword) as n, list_sort(list_distinct(list_filter(regexp_split_to_array(low, '\\s+'), lambda w: w <> ''))) as y,
    list_sort(list_distinct(string_split(keyword, ' '))) as x from k),
  w as (select item_id, ord, n, s, t[greatest(1, pos):pos + n - 1] as part from (select *, unnest(range(2 - n, len(t) + 1)) as pos from c where not contains(low, keyword))),
  partial as (select item_id, ord, max(200.0::double * {_lcs_sql('s', 'part')} / (n + len(part))) as score from w group by 1, 2),
  sets as (select *, array_to_string(list_filter(x, lambda v: list_contains(y, v)), ' ') as common, list_filter(x, lambda v: not list_contains(y, v)) as own,
    list_filter(y, lambda v: not list_contains(x, v)) as other from c),
  pair as (select *, trim(common || ' ' || array_to_string(own, ' ')) as l, trim(common || ' ' || array_to_string(other, ' ')) as r from sets),
  token as (select item_id, ord, keyword, contains(low, keyword) as inside, case when common <> '' and (len(own) = 0 or len(other) = 0) then 100 else greatest(
    200.0::double * {_lcs_sql("string_split(l, '')", "string_split(r, '')")} / (length(l) + length(r)),
    if(common = '', 0, 200.0::double * length(common) / (length(common) + length(l))), if(common = '', 0, 200.0::double * length(common) / (length(common) + length(r)))) end as score from pair),
  scored as (select t.item_id, t.ord, keyword, case when inside then 100 else greatest(t.score, p.score) end as score from token t left join partial p on p.item_id = t.item_id and p.ord = t.ord),
  best as (select item_id, arg_max(keyword, (score, -ord)) as keyword, max(score) as score, count(*) filter (score >= 70) as hits from scored group by 1)
  select item_id, keyword, round(score / 100, 4) as score, hits, case when score >= 70 and hits >= 1 then 'PASS' when score >= 62 then 'REVIEW' else 'REJECT' end as decision from best""")
def fuzzy_best_keyword(spark, d):
    """The best of a few keywords for each item of the benchmark table, first listed on ties."""
    items = t(spark, d, "benchmark").withColumn("s", text.keyword_scores(F.col("text"), F.array(*map(F.lit, _KEYS)), 70.0))
    score = F.round(F.col("s.best") / 100, 4)
    return items.select("item_id", "s.keyword", score.alias("score"), "s.hits", gates.keyword_decision(F.col("s.best"), F.col("s.hits")).alias("decision"))


@query("""select l_orderkey, l_linenumber, round(least(1, greatest(0, l_quantity / 50)) * 0.4 + least(1, greatest(0, l_discount * 10)) * 0.35
   + least(1, greatest(0, 1 - l_extendedprice / 100000)) * 0.25, 4) + 0.0 as score from lineitem""")
def quality_composite(spark, d):
    parts = {
        "quantity": (F.col("l_quantity") / 50, 0.4),
        "discount": (F.col("l_discount") * 10, 0.35),
        "price": (1 - F.col("l_extendedprice") / 100000, 0.25),
    }
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (gates.quality_composite(parts) + 0.0).alias("score"))


_LIMITS = {"min_duration": 3, "max_duration": 48, "silence": 0.09, "clipping": 0.07, "dynamic_range": 2000, "snr": 1.0, "noise_floor": 90000, "dropout": 6, "rolloff": 0.01, "sample_rate": 2}


@query("""select case when l_quantity < 3 then 'TOO_SHORT' when l_quantity > 48 then 'TOO_LONG' when l_discount > 0.09 then 'MOSTLY_SILENT'
   when l_tax > 0.07 then 'EXCESSIVE_CLIPPING' when l_extendedprice < 2000 then 'SEVERE_DISTORTION' when l_linenumber < 1 then 'VERY_LOW_SNR'
   when l_extendedprice > 90000 then 'EXCESSIVE_NOISE' when l_linenumber > 6 then 'AUDIO_DROPOUT'
   when l_discount < 0.01 or l_linenumber < 2 then 'LOW_BANDWIDTH' end as code, count(*) as n from lineitem group by 1""")
def quality_reject_order(spark, d):
    c = F.col
    m = {"duration": c("l_quantity"), "silence": c("l_discount"), "clipping": c("l_tax"), "dynamic_range": c("l_extendedprice"), "snr": c("l_linenumber"),
         "noise_floor": c("l_extendedprice"), "dropout": c("l_linenumber"), "rolloff": c("l_discount"), "sample_rate": c("l_linenumber")}
    code = scoring.first_of(gates.quality_rules(m, _LIMITS))
    return t(spark, d, "lineitem").groupBy(code.alias("code")).agg(F.count("*").alias("n"))


@query("""with x as (select l_orderkey, l_linenumber, l_discount - 0.05 as a, l_tax - 0.04 as b, 0.1 - l_quantity / 250 as c from lineitem)
  select l_orderkey, l_linenumber, case when a >= b and a >= c then 'MOSTLY_SILENT' when b >= c then 'EXCESSIVE_CLIPPING' else 'VERY_LOW_SNR' end as code from x""")
def override_code_picker(spark, d):
    excess = [(F.col("l_discount") - 0.05, "MOSTLY_SILENT"), (F.col("l_tax") - 0.04, "EXCESSIVE_CLIPPING"), (0.1 - F.col("l_quantity") / 250, "VERY_LOW_SNR")]
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", gates.override_code(excess).alias("code"))


_SIGNALS = """select d.doc_id, q.quality::double * 0.4 + 0.5 as quality, case when d.n_chars % 7 = 0 then null else (d.n_chars % 100) / 100.0::double end as relevance,
    case when d.n_chars % 5 = 0 then null else (d.n_chars % 90) / 100.0::double end as music, (d.n_chars % 101) / 100.0::double as speech, d.lang = 'fr' as narration
  from documents d left join (select doc_id, min(quality) as quality from labels group by 1) q using (doc_id)"""
_SCORE = """round(coalesce((coalesce(quality * 0.4, 0) + coalesce(relevance * 0.3, 0) + coalesce(music * 0.2, 0) + coalesce(speech * 0.1, 0))
    / nullif((case when quality is null then 0.0::double else 0.4 end) + (case when relevance is null then 0.0 else 0.3 end) + (case when music is null then 0.0 else 0.2 end)
      + (case when speech is null then 0.0 else 0.1 end), 0), 0), 4)"""


def _signals(spark: SparkSession, d: str) -> DataFrame:
    quality = t(spark, d, "labels").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    n = F.col("n_chars")
    return t(spark, d, "documents").join(quality, "doc_id", "left").select(
        "doc_id",
        (F.col("quality").cast("double") * 0.4 + 0.5).alias("quality"),
        F.when(n % 7 != 0, (n % 100) / 100.0).alias("relevance"),
        F.when(n % 5 != 0, (n % 90) / 100.0).alias("music"),
        ((n % 101) / 100.0).alias("speech"),
        (F.col("lang") == "fr").alias("narration"),
    )


@query(f"select doc_id, {_SCORE} as score from ({_SIGNALS})")
def weighted_renorm(spark, d):
    score = gates.final_score(F.col("quality"), F.col("relevance"), F.col("music"), F.col("speech"))
    return _signals(spark, d).select("doc_id", score.alias("score"))


@query(f"""with s as (select *, {_SCORE} as score, case when music >= 0.25 and music >= speech then 'SONG' when speech >= 0.85 and speech > music then 'SPEECH'
    when music >= 0.25 and speech >= 0.25 then 'MIXED' else 'UNKNOWN' end as label from ({_SIGNALS})),
  c as (select *, case when quality < 0.55 then 'SEVERE_DISTORTION'
    when label = 'SPEECH' and coalesce(music, 0) < 0.25 and (case when narration then speech > 0.92 else speech >= 0.85 end) then 'SPEECH'
    when music < 0.25 and relevance < 0.4 then 'NON_SONG' when score < 0.4 and relevance < 0.4 then 'NON_FOLK' when score < 0.4 then 'NON_SONG' end as code from s)
  select doc_id, label, score, code, case when code is not null then 'REJECT' when score < 0.5 then 'REVIEW' else 'ACCEPT' end as decision from c""")
def final_decision(spark, d):
    c = F.col
    s = _signals(spark, d)
    s = s.withColumn("score", gates.final_score(c("quality"), c("relevance"), c("music"), c("speech")))
    s = s.withColumn("label", gates.sound_label(c("music"), c("speech")))
    code = gates.final_code(c("quality"), c("relevance"), c("music"), c("speech"), c("label"), c("narration"), c("score"), F.lit("SEVERE_DISTORTION"))
    s = s.withColumn("code", code)
    return s.select("doc_id", "label", "score", "code", gates.final_decision(c("code"), c("score"), F.lit(False)).alias("decision"))


_RUN = """(select event_id, ts, user_id, event_type, case when value < 20 then 'REJECT' when value < 50 then 'REVIEW' else 'ACCEPT' end as decision,
  case when value < 20 then 'CODE_' || event_type end as rejection_code from events)"""


def _run(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("value")
    decision = F.when(v < 20, "REJECT").when(v < 50, "REVIEW").otherwise("ACCEPT")
    code = F.when(v < 20, F.concat(F.lit("CODE_"), "event_type"))
    return t(spark, d, "events").select("event_id", "ts", "user_id", "event_type", decision.alias("decision"), code.alias("rejection_code"))


@query(f"""select user_id, case when bool_or(decision = 'REJECT') then 'REJECT' when bool_or(decision = 'REVIEW') then 'REVIEW' else 'ACCEPT' end as decision,
  arg_min(rejection_code, event_id) filter (decision = 'REJECT') as rejection_code from {_RUN} group by 1""")
def decision_fold(spark, d):
    return gates.fold_decisions(_run(spark, d), "user_id", "event_id")


@query(f"select user_id, arg_max(decision, event_id) as decision, max(event_id) as event_id from {_RUN} group by 1")
def runlog_latest(spark, d):
    return last_by_key(_run(spark, d), "user_id", "event_id").select("user_id", "decision", "event_id")


@query(f"""select decision, count(*) as n from (select arg_max(decision, event_id) as decision from {_RUN} group by user_id) group by 1""")
def runlog_counts(spark, d):
    return last_by_key(_run(spark, d), "user_id", "event_id").groupBy("decision").agg(F.count("*").alias("n"))


@query(f"""select event_type, count(*) filter (decision = 'ACCEPT') as accepted, count(*) filter (decision = 'REVIEW') as review,
  count(*) filter (decision = 'REJECT') as rejected from {_RUN} group by rollup (event_type)""")
def run_totals_rollup(spark, d):
    count = lambda x: F.count_if(F.col("decision") == x)
    return _run(spark, d).rollup("event_type").agg(count("ACCEPT").alias("accepted"), count("REVIEW").alias("review"), count("REJECT").alias("rejected"))


@query("select o_orderkey, o_custkey from orders where o_orderkey not in (select l_orderkey from lineitem where l_quantity > 45)")
def resume_anti(spark, d):
    done = t(spark, d, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return t(spark, d, "orders").join(done, "o_orderkey", "left_anti").select("o_orderkey", "o_custkey")


@query("select doc_id, source from documents where doc_id in (select doc_id from labels where quality = 1)")
def resume_semi(spark, d):
    return t(spark, d, "documents").join(t(spark, d, "labels").where("quality = 1"), "doc_id", "left_semi").select("doc_id", "source")


@query("""select event_id, coalesce(case when event_id % 10 = 0 then null else try_cast(json_extract_string(props, '$.k') as bigint) end, -1) as k from events""")
def json_tolerant_parse(spark, d):
    broken = F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("{broken"), "props")).otherwise(F.col("props"))
    return t(spark, d, "events").select("event_id", F.coalesce(F.from_json(broken, "k bigint")["k"], F.lit(-1)).alias("k"))


@query("""select l_suppkey, count(*) as hits, min(l_orderkey) as first_seen from lineitem group by 1 order by 2 desc, 3, 1 limit 5""")
def topk_contributors(spark, d):
    return discovery.top_contributors(t(spark, d, "lineitem"), "l_suppkey", "l_orderkey")


@query("""with r as (select event_id, user_id as recording_id, event_id % 3 as rnd from events),
  f as (select recording_id, min(rnd * 1000000000 + event_id) as k from r group by 1)
  select recording_id, (k % 1000000000)::bigint as ord, (k // 1000000000 + 1)::int as round from f where recording_id not in (select user_id from events where event_id < 20)""")
def discovery_fixpoint(spark, d):
    events = t(spark, d, "events").select(F.col("user_id").alias("recording_id"), F.col("event_id").alias("ord"))
    found = discovery.discover(lambda n, _: events.where(F.col("ord") % 3 == n - 1), events.where("ord < 20"))
    return found.select("recording_id", "ord", "round")


@query("""select event_type, user_id, event_id from (select *, row_number() over (partition by event_type, user_id order by event_id) n from events) where n = 1""")
def ordered_distinct(spark, d):
    rows = t(spark, d, "events").withColumn("v", F.concat_ws(":", "event_type", "user_id"))
    return discovery.ordered_distinct(rows, "v", "event_id").select("event_type", "user_id", "event_id")


_COS = """with e as (select vec_id, label, embedding from embeddings), refs as (select * from (select *, row_number() over (partition by label order by vec_id) n from e) where n <= 4),
  s as (select e.vec_id, max(list_dot_product(e.embedding::double[], r.embedding::double[])) as sim
        from e join refs r on e.label = r.label where e.vec_id not in (select vec_id from refs) group by 1)"""


def _similarity(spark: SparkSession, d: str) -> DataFrame:
    """The best dot product of each vector with the four references of its label."""
    e = t(spark, d, "embeddings")
    first = Window.partitionBy("label").orderBy("vec_id")
    numbered = e.withColumn("n", F.row_number().over(first))
    refs = numbered.where("n <= 4").groupBy("label").agg(F.collect_list("embedding").alias("refs"))  # four a label
    best = F.array_max(F.transform("refs", lambda r: scoring.dot(F.col("embedding"), r)))
    return numbered.where("n > 4").join(refs, "label").select("vec_id", best.alias("sim"))


@query(_COS + "select vec_id, round(sim, 4) + 0.0 as similarity, case when sim >= 0.35 then 'PASS' when sim >= 0.25 then 'REVIEW' else 'REJECT' end as decision from s")
def max_cosine_refs(spark, d):
    s = _similarity(spark, d)
    return s.select("vec_id", (F.round("sim", 4) + 0.0).alias("similarity"), gates.relevance_decision(F.col("sim")).alias("decision"))


@query(_COS + """select vec_id, round(case when abs(sim - 0.25) <= 0.06 then 0.5 * sim + 0.5 * ((vec_id % 100) / 100.0::double) else sim end, 4) + 0.0 as similarity from s""")
def band_blend(spark, d):
    """The second model (here a stand-in column) sees the rows of the undecided band only."""
    s = _similarity(spark, d)
    band = F.abs(F.col("sim") - 0.25) <= 0.06
    second = s.where(band).withColumn("sim", 0.5 * F.col("sim") + 0.5 * ((F.col("vec_id") % 100) / 100.0))
    return s.where(~band).unionByName(second).select("vec_id", (F.round("sim", 4) + 0.0).alias("similarity"))


_PAIRS = """with recursive b as (select vec_id, list_transform(embedding, lambda x: (x > 0)::int) as b from embeddings),
  p as (select x.vec_id as ord, y.vec_id as other, 1 - list_sum(list_transform(range(1, 65), lambda i: xor(x.b[i], y.b[i]))) / 64.0::double as similarity
        from b x join b y on y.vec_id < x.vec_id), pairs as (select * from p where similarity >= 0.70)"""


def _prints(spark: SparkSession, d: str) -> DataFrame:
    """Signs of the 64 components as two 32-bit words."""
    word = lambda a: F.aggregate(
        F.slice("embedding", a, 32), F.lit(0).cast("long"), lambda s, x: s * 2 + F.when(x > 0, 1).otherwise(0)
    )
    return t(spark, d, "embeddings").select(F.col("vec_id").alias("ord"), F.array(word(1), word(33)).alias("fp"))


@query(_PAIRS + "select ord, other, similarity from pairs")
def hamming_pairs(spark, d):
    return dedupe.similar_pairs(_prints(spark, d), 0.70)


@query(_PAIRS + """select ord, arg_max(other, (similarity, -other)) as duplicate_of, max(similarity) as similarity from pairs group by 1""")
def dedupe_any_earlier(spark, d):
    return dedupe.any_earlier(_prints(spark, d), 0.70)


_LEVELS = [round(0.02 * i - 0.15, 2) for i in range(16)]


# Prints of nine lengths: a 32-bit word for each level, which of the first 32 components exceed it.
@query(f"""with b as (select vec_id, list_transform([{", ".join(map(str, _LEVELS))}][1:8 + vec_id % 9], lambda c:
    list_sum(list_transform(range(1, 33), lambda i: if(embedding[i]::double > c, 1::bigint << (32 - i), 0)))::bigint) as fp from embeddings),
  p as (select x.vec_id as ord, y.vec_id as other, least(len(x.fp), len(y.fp)) as n, x.fp as f, y.fp as g from b x join b y on y.vec_id < x.vec_id)
  select ord, other, similarity from (select ord, other, 1 - list_sum(list_transform(range(1, n + 1), lambda i: bit_count(xor(f[i], g[i])))) / (32.0::double * n) as similarity from p)
  where similarity >= 0.78""")
def hamming_mixed_lengths(spark, d):
    word = lambda c: F.aggregate(F.slice("embedding", 1, 32), F.lit(0).cast("long"), lambda s, x: s * 2 + F.when(x.cast("double") > c, 1).otherwise(0))
    whole = F.array(*(word(c) for c in _LEVELS))
    made = t(spark, d, "embeddings").select(F.col("vec_id").alias("ord"), F.slice(whole, F.lit(1), (8 + F.col("vec_id") % 9).cast("int")).alias("fp"))
    return dedupe.similar_pairs(made, 0.78)


# One pass in order: the state holds the orders that were kept; each step decides the next row.
_GREEDY = _PAIRS + """, n as (select vec_id, row_number() over (order by vec_id) as i from embeddings),
  near as (select n.i, n.vec_id, list(p.other) as others, list(p.similarity) as sims from n left join pairs p on p.ord = n.vec_id group by 1, 2),
  pass as (select 0 as i, []::bigint[] as kept union all
    select near.i, case when len(list_intersect(kept, others)) > 0 then kept else list_append(kept, near.vec_id) end
    from pass join near on near.i = pass.i + 1),
  last as (select kept from pass order by i desc limit 1)
  select n.vec_id as ord, arg_max(p.other, (p.similarity, -p.other)) filter (list_contains(kept, p.other)) as duplicate_of
  from n cross join last left join pairs p on p.ord = n.vec_id group by 1"""


@query(_GREEDY)
def dedupe_greedy(spark, d):
    return dedupe.greedy(_prints(spark, d), 0.70)


@query("select min(doc_id) as doc_id, count(*) as copies, md5(text) as digest from documents group by text")
def exact_copy_dedupe(spark, d):
    digest = F.md5(F.col("text").cast("binary"))
    return t(spark, d, "documents").groupBy(digest.alias("digest")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))


_VERSES = r"""(select conv_id, turn, role, whole, case when whole = '' then '[Verse 1]' || chr(10) || '[Instrumental / No Speech Detected]' else
  list_reduce(list_transform(p, lambda s: {'out': s, 'held': 0, 'verse': 0}), lambda a, x: {
    'out': a.out || chr(10) || x.out || case when a.held >= 2 and x.out <> p[len(p)] then chr(10) || chr(10) || '[Verse ' || (a.verse + 1) || ']' else '' end,
    'held': case when a.held >= 2 and x.out <> p[len(p)] then 0 else a.held + 1 end,
    'verse': case when a.held >= 2 and x.out <> p[len(p)] then a.verse + 1 else a.verse end}, {'out': '[Verse 1]', 'held': 0, 'verse': 1}).out end as verses
  from (select *, case when len(f) = 0 then [whole] else f end as p from (select *, list_filter(list_transform(
    regexp_split_to_array(whole, '[\n.!?|]+'), lambda s: trim(s, E' \t\n\r')), lambda s: s <> '') as f
    from (select conv_id, turn, role, trim(coalesce(text, ''), E' \t\n\r') as whole from conversations))))"""


@query("select conv_id, turn, verses from " + _VERSES)
def verse_layout(spark, d):
    return t(spark, d, "conversations").select("conv_id", "turn", text.verses(F.col("text")).alias("verses"))


@query("""select conv_id, turn, 'Title: ' || case when turn % 3 = 0 then 'Tamil Folk Song' else 'turn ' || turn end || chr(10) || 'Artist: ' || coalesce(nullif(role, ''), 'Unknown Artist')
  || chr(10) || 'Language: Tamil' || chr(10) || 'Source: YouTube' || chr(10) || 'Category: c' || conv_id || chr(10) || chr(10) || verses as content from """ + _VERSES)
def lyrics_file(spark, d):
    title = F.when(F.col("turn") % 3 == 0, "").otherwise(F.concat(F.lit("turn "), "turn"))
    made = text.lyrics_file(title, F.col("role"), F.concat(F.lit("c"), "conv_id"), F.lit(None).cast("string"), F.col("text"))
    return t(spark, d, "conversations").select("conv_id", "turn", made.alias("content"))


@query("""select event_id, case event_id % 5 when 0 then 'a ' || event_type when 1 then event_type || 'two' when 2 then event_type || '!' else '' end as transcript from events""")
def response_text(spark, d):
    """Answers in four shapes, and one that is no JSON."""
    kind, n = F.col("event_type"), F.col("event_id") % 5
    body = (
        F.when(n == 0, F.format_string('{"text": " a %s "}', kind))
        .when(n == 1, F.format_string('{"text": "", "transcript": ["%s", "two"]}', kind))
        .when(n == 2, F.format_string('{"text": [], "result": [{"text": "%s", "start": 1}, {"text": "!"}]}', kind))
        .when(n == 3, F.lit('{"other": 1}'))
        .otherwise("no json {")
    )
    return t(spark, d, "events").select("event_id", text.response_text(body).alias("transcript"))


@query("""select page_id, case when page_id % 3 = 0 then url || '/transcribe' else rtrim(url, '/') || '/api/transcribe' end as address from pages""")
def endpoint_address(spark, d):
    given = F.when(F.col("page_id") % 3 == 0, F.concat("url", F.lit("/transcribe"))).otherwise(F.concat(F.lit(" "), "url", F.lit("//")))
    return t(spark, d, "pages").select("page_id", text.endpoint(given).alias("address"))


_FILES = """(select 'store/out/' || case when doc_id % 4 = 0 then 'review/' else '' end || source || '/' || doc_id || case when k = 0 then '.wav' else '.txt' end as path,
  n_chars % 60 as length from documents, (values (0), (1)) v(k) where k = 0 or doc_id % 3 > 0)"""


def _files(spark: SparkSession, d: str) -> DataFrame:
    """A listing of an audio file for each document, and of a text for two in three."""
    review = F.col("doc_id") % 4 == 0
    place = lambda ext: storage.output_path(F.lit("store"), F.lit("out"), F.col("source"), F.col("doc_id").cast("string"), ext, review)
    paths = F.array_compact(F.array(place("wav"), F.when(F.col("doc_id") % 3 > 0, place("txt"))))
    return t(spark, d, "documents").select(F.explode(paths).alias("path"), (F.col("n_chars") % 60).alias("length"))


@query(f"""select category, count(*) filter (wav and not review) as accepted, count(*) filter (not wav and not review) as texts, count(*) filter (wav and review) as review
  from (select regexp_extract(path, '^store/out/(review/)?([^/]+)/', 2) as category, path like '%.wav' as wav, path like '%/review/%' as review from {_FILES}) group by 1""")
def category_counts(spark, d):
    return storage.category_counts(_files(spark, d), "store/out/")


@query(f"""with f as {_FILES} select path, length from f where path like '%.wav' and
  replace(path, '.wav', '.txt') not in (select path from f where path like '%.txt' and length > 20)""")
def missing_transcripts(spark, d):
    return storage.missing_transcripts(_files(spark, d))


@query("""select doc_id as recording_id, source as category_slug, case when doc_id % 4 = 0 then 'REVIEW' else 'ACCEPT' end as decision from documents
  where doc_id % 4 = 0 or doc_id % 3 > 0""")
def stored_outputs(spark, d):
    decision = F.when(F.col("doc_id") % 4 == 0, "REVIEW").otherwise("ACCEPT")
    decided = t(spark, d, "documents").select(F.col("doc_id").alias("recording_id"), F.col("source").alias("category_slug"), decision.alias("decision"))
    return storage.stored(decided, _files(spark, d), "store", "out")


@query("""select count(*) as total, count(*) filter (value < 20) as done, count(*) filter (value >= 20 and event_id % 2 = 0) as transcribed,
  greatest(0, count(*) filter (value >= 20 and event_id % 2 <> 0)) as remaining from events""")
def backfill_totals(spark, d):
    return storage.backfill_totals(t(spark, d, "events").select((F.col("value") < 20).alias("done"), (F.col("event_id") % 2 == 0).alias("success")))


@query(f"select user_id, case when bool_or(decision = 'ACCEPT') then 'ACCEPT' else 'REJECT' end as decision, null::varchar as rejection_code from {_RUN} group by 1")
def parent_decisions(spark, d):
    return gates.parent_decisions(_run(spark, d), "user_id")


_SUB = "least(1, greatest(0, {})) * {}"


@query("select l_orderkey, l_linenumber, round(" + " + ".join(_SUB.format(x, w) for x, w in [
    ("1 - l_discount * 4 / 0.45", 0.18), ("1 - l_tax / 0.05", 0.14), ("(l_quantity - 5) / 25", 0.18), ("(-25 + l_quantity) / 30", 0.12),
    ("(l_quantity - 4) / 36", 0.12), ("1 - l_discount / 0.1", 0.10), ("l_extendedprice / 8000", 0.10)])
    + " + case when l_linenumber = 1 then 0.7 when -l_quantity between -45 and -4 then 1 else 0.4 end * 0.06, 4) + 0.0 as score from lineitem")
def quality_score(spark, d):
    c = F.col
    m = {"silence": c("l_discount") * 4, "clipping": c("l_tax"), "snr": c("l_quantity"), "noise_floor": -c("l_quantity"), "dynamic_range": c("l_quantity"),
         "dropout": c("l_discount"), "rolloff": c("l_extendedprice"), "lufs": F.when(c("l_linenumber") > 1, -c("l_quantity"))}
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (gates.quality_score(m) + 0.0).alias("score"))


@query("""with g as (select p_partkey, [upper(p_name), p_name || '/' || p_type || ',' || p_name] || string_split(replace(p_name || '/' || p_type || ',' || p_name, '/', ','), ',') || [p_brand, ' ' || lower(p_brand)] as g from part),
  k as (select p_partkey, list_filter(list_transform(g, lambda x: trim(x)), lambda x: x <> '') as k from g)
  select p_partkey, array_to_string(list_filter(k, lambda x, i: list_position(list_transform(k, lambda y: lower(y)), lower(x)) = i), '|') as keywords from k""")
def category_keywords(spark, d):
    english = F.concat("p_name", F.lit("/"), "p_type", F.lit(","), "p_name")
    found = settings.keywords(F.upper("p_name"), english, F.array("p_brand", F.concat(F.lit(" "), F.lower("p_brand"))))
    return t(spark, d, "part").select("p_partkey", F.array_join(found, "|").alias("keywords"))


@query("select conv_id, string_agg(text, ' ' order by turn) as transcript from conversations group by 1")
def transcript_join(spark, d):
    parts = F.sort_array(F.collect_list(F.struct("turn", "text")))
    joined = F.array_join(F.transform(parts, lambda p: p["text"]), " ")
    return t(spark, d, "conversations").groupBy("conv_id").agg(joined.alias("transcript"))


@query("select doc_id from documents where doc_id not in (select doc_id from labels) and n_chars > 20")
def missing_text(spark, d):
    return t(spark, d, "documents").where("n_chars > 20").join(t(spark, d, "labels"), "doc_id", "left_anti").select("doc_id")


@query("""select regexp_extract(url, '^[a-z]+://([^/]+)', 1) as host, count(*) filter (contains(url, 'page=')) as paged, count(*) filter (contains(url, '#')) as anchored,
  count(*) as n from pages group by 1""")
def listing_counts(spark, d):
    host = F.regexp_extract("url", "^[a-z]+://([^/]+)", 1)
    counts = (F.count_if(F.col("url").contains("page=")).alias("paged"), F.count_if(F.col("url").contains("#")).alias("anchored"), F.count("*").alias("n"))
    return t(spark, d, "pages").groupBy(host.alias("host")).agg(*counts)


_MARKS = "['v=', 'youtu.be/', '/shorts/', '/watch/']"


# The first place where a mark stands with eleven characters of an id behind it.
@query(f"""with u as (select page_id, case page_id % 5 when 0 then 'https://m.example/watch?v=' || substr(md5(url), 1, 11) || '&x=1'
    when 1 then 'youtu.be/' || substr(md5(url), 1, 11) when 2 then 'v=' || substr(md5(url), 1, 11) when 3 then substr(md5(url), 1, 11) else url end as u from pages),
  p as (select page_id, u, unnest(range(1, length(u) + 1)) as i from u), m as (select page_id, u, i, unnest({_MARKS}) as mark from p),
  f as (select page_id, arg_min(substr(u, i + length(mark), 11), i) as id from m
    where substr(u, i, length(mark)) = mark and regexp_full_match(substr(u, i + length(mark), 11), '[A-Za-z0-9_-]{{11}}') group by 1)
  select u.page_id, coalesce(id, u) as media_id from u left join f on f.page_id = u.page_id""")
def video_id_extract(spark, d):
    short = F.substring(F.md5("url"), 1, 11)
    p = F.col("page_id") % 5
    u = F.when(p == 0, F.concat(F.lit("https://m.example/watch?v="), short, F.lit("&x=1"))).when(p == 1, F.concat(F.lit("youtu.be/"), short))
    u = u.when(p == 2, F.concat(F.lit("v="), short)).when(p == 3, short).otherwise(F.col("url"))
    return t(spark, d, "pages").select("page_id", text.media_id(u).alias("media_id"))


@query("""select user_id, count(*) filter (value < 20 and around > 50) as dropouts, count(*) as frames from
  (select *, median(value) over (partition by user_id order by event_id rows between 6 preceding and 6 following exclude current row) as around from events) group by 1""")
def dropout_window(spark, d):
    w = Window.partitionBy("user_id").orderBy("event_id")
    near = F.array_sort(F.concat(F.collect_list("value").over(w.rowsBetween(-6, -1)), F.collect_list("value").over(w.rowsBetween(1, 6))))
    n = F.size("near")
    middle = (F.get("near", F.floor((n - 1) / 2).cast("int")) + F.get("near", F.floor(n / 2).cast("int"))) / 2
    rows = t(spark, d, "events").select("user_id", "value", near.alias("near")).withColumn("around", middle)
    return rows.groupBy("user_id").agg(F.count_if((F.col("value") < 20) & (F.col("around") > 50)).alias("dropouts"), F.count("*").alias("frames"))


@query("""select event_type, round(quantile_cont(value, 0.05), 4) as p05, round(median(value), 4) as p50, round(quantile_cont(value, 0.95), 4) as p95 from events group by 1""")
def percentile_floor(spark, d):
    found = quantiles.exact_quantiles(t(spark, d, "events"), "event_type", "value", (0.05, 0.5, 0.95))
    pick = lambda q: F.round(F.max(F.when(F.col("quantile") == q, F.col("value"))), 4)
    return found.groupBy("event_type").agg(pick(0.05).alias("p05"), pick(0.5).alias("p50"), pick(0.95).alias("p95"))


@query("""select user_id, round(least(1, sum(case when event_id % 3 = 0 then 5 else 0 end) / (count(*) * 4.0::double)), 4) as vocal_ratio,
  max(value) filter (event_type in ('click', 'purchase')) as music, max(value) filter (event_type in ('view', 'scroll')) as speech from events group by 1""")
def voice_and_tags(spark, d):
    g = t(spark, d, "events").groupBy("user_id").agg(
        F.sum(F.when(F.col("event_id") % 3 == 0, 5).otherwise(0)).alias("inside"), (F.count("*") * 4).alias("total"),
        gates.tag_max(["click", "purchase"], F.col("event_type"), F.col("value")).alias("music"),
        gates.tag_max(["view", "scroll"], F.col("event_type"), F.col("value")).alias("speech"),
    )
    return g.select("user_id", gates.voiced_share(F.col("inside"), F.col("total")).alias("vocal_ratio"), "music", "speech")


@query("select event_type, count(*) as records, true as ids_near, true as median_near from events group by 1")
def audit_sketches(spark, d):
    """Sketches of ten batches merged, held against the exact figures: both lie within the stated errors."""
    log = t(spark, d, "events").select(F.col("user_id").alias("recording_id"), F.col("event_type").alias("category_slug"), (F.col("event_id") % 3).alias("decision"),
                                       F.col("value").alias("final_score"), (F.col("event_id") % 10).alias("batch"))
    kept = sketches.merged(sketches.summarise(log, ("category_slug", "decision", "batch")), ("category_slug",))
    read = kept.select("category_slug", "records", F.hll_sketch_estimate("ids").alias("ids"), F.kll_sketch_get_quantile_double("scores", F.lit(0.5)).alias("median"))
    exact = log.join(read, "category_slug").groupBy("category_slug").agg(
        F.first("records").alias("records"), (F.abs(F.first("ids") / F.count_distinct("recording_id") - 1) <= 4 * sketches.ID_ERROR).alias("ids_near"),
        (F.abs(F.count_if(F.col("final_score") <= F.col("median")) / F.count("*") - 0.5) <= sketches.RANK_ERROR).alias("median_near"),
    )
    return exact.withColumnRenamed("category_slug", "event_type")


# The boundaries one by one; only the last piece can be shorter than the least length, and then takes the boundary before it along.
@query("""with recursive u as (select user_id, list(value order by event_id) as f, count(*)::bigint as total from events group by 1),
  walk(user_id, k, pos) as (select user_id, 0::bigint, 0::bigint from u union all
    select w.user_id, k + 1, pos + 3 + list_position(u.f[pos + 4:least(pos + 12, total)], list_min(u.f[pos + 4:least(pos + 12, total)])) - 1
    from walk w join u on u.user_id = w.user_id where pos + 8 < total),
  cut as (select walk.user_id, k, pos, total, max(k) over (partition by walk.user_id) as last from walk join u on u.user_id = walk.user_id),
  kept as (select * from cut where k = 0 or k < last or total - pos >= 3)
  select user_id, k::int as piece, pos::double as start_s, lead(pos, 1, total) over (partition by user_id order by k)::double as end_s from kept""")
def chunk_assign(spark, d):
    """Each user's events as a frame series, split at the quietest frames by a table function."""
    return splitter.split_series(t(spark, d, "events"), "user_id", "event_id", "value", per_second=1.0, least=3.0, target=8.0, most=12.0)


@query("""select c_mktsegment, n_name, count(*) as n from customer join nation on c_nationkey = n_nationkey group by cube (c_mktsegment, n_name)""")
def category_cube(spark, d):
    nation = F.broadcast(t(spark, d, "nation"))  # 25 rows: the category dimension has a fixed size
    return t(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).cube("c_mktsegment", "n_name").agg(F.count("*").alias("n"))


@query(f"""select strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') as hour, decision, count(*) as n from {_RUN} group by 1, 2""")
def windowed_decisions(spark, d):
    """The streaming counts over a table that is read as a batch."""
    counted = stream.decision_counts(_run(spark, d))
    return counted.select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("hour"), "decision", F.col("count").alias("n"))


@query(f"""select event_type, count(*) filter (decision = 'ACCEPT') as accept, count(*) filter (decision = 'REVIEW') as review,
  count(*) filter (decision = 'REJECT') as reject from {_RUN} group by 1""")
def category_decisions(spark, d):
    return gates.decision_counts(_run(spark, d), "event_type")


_OVER = [("n_chars % 50 / 100.0 - 0.45", "MOSTLY_SILENT"), ("n_chars % 6 / 100.0 - 0.05", "EXCESSIVE_CLIPPING"), ("5 - (4 + n_chars % 30)", "VERY_LOW_SNR"),
         ("-60 + n_chars % 37 + 25", "EXCESSIVE_NOISE"), ("4 - (3 + n_chars % 40)", "SEVERE_DISTORTION"), ("n_chars % 12 / 100.0 - 0.1", "AUDIO_DROPOUT"),
         ("3000 - (2900 + n_chars % 5000)", "LOW_BANDWIDTH")]
_OVERRIDE = "list_sort([" + ", ".join(f"{{'d': -({x})::double, 'o': {i}, 'c': '{c}'}}" for i, (x, c) in enumerate(_OVER)) + "])[1].c"


def _metrics() -> dict:
    n = F.col("n_chars")
    whole = {"duration": n / 10.0, "silence": n % 50 / 100.0, "clipping": n % 6 / 100.0, "dynamic_range": 3 + n % 40, "snr": 4 + n % 30,
             "noise_floor": -60 + n % 37, "dropout": n % 12 / 100.0, "rolloff": 2900 + n % 5000, "sample_rate": F.lit(16000), "lufs": F.when(n % 9 > 0, -(n % 50))}
    return {k: v.cast("double") for k, v in whole.items()}


@query(f"select doc_id, {_OVERRIDE} as code from documents")
def quality_override(spark, d):
    return t(spark, d, "documents").select("doc_id", gates.quality_override(_metrics()).alias("code"))


_BROKEN = """(n_chars % 50 = 0 or n_chars % 61 = 0 or n_chars % 45 = 0 or abs(n_chars / 10.0 - (n_chars / 10.0 + case when n_chars % 37 = 0 then 40 else 0.5 end)) >
  greatest(1.0, 0.15 * (n_chars / 10.0)))"""


def _probe() -> dict:
    n = F.col("n_chars")
    return {"exists": n % 50 != 0, "size": n % 61, "frames": F.when(n % 45 != 0, n), "has_stream": n >= 0, "container": n / 10.0,
            "pcm": n / 10.0 + F.when(n % 37 == 0, 40.0).otherwise(0.5)}


@query(f"select doc_id, case when {_BROKEN} then 'CORRUPT_AUDIO' end as code from documents")
def integrity_gate(spark, d):
    return t(spark, d, "documents").select("doc_id", gates.integrity_code(*_probe().values()).alias("code"))


@query("""select page_id, case when page_id % 4 = 0 then '' else 't ' || page_id end as cleaned, case when page_id % 4 = 0 and page_id % 3 = 0 then 'fallback'
  else trim((case when page_id % 4 = 0 then '' else 't ' || page_id end) || case when page_id % 3 = 0 then '' else ' [SONG]' end) end as evidence from pages""")
def evidence_text(spark, d):
    p = F.col("page_id")
    title = F.when(p % 4 == 0, "").otherwise(F.concat(F.lit("t "), p.cast("string")))
    label = F.when(p % 3 == 0, "UNKNOWN").otherwise("SONG")
    return t(spark, d, "pages").select("page_id", title.alias("cleaned"), text.evidence(title, label, F.lit("fallback")).alias("evidence"))


_second = models.batch_model(lambda: lambda ids: (ids % 100) / 100.0, "double")  # a stand-in for the second encoder


@query(_COS + """, b as (select vec_id, case when abs(sim - 0.25) <= 0.06 then 0.5 * sim + 0.5 * ((vec_id % 100) / 100.0::double) else sim end as sim from s)
  select vec_id, round(sim, 4) + 0.0 as score, case when sim >= 0.35 then 'PASS' when sim >= 0.25 then 'REVIEW' else 'REJECT' end as decision,
    case when sim < 0.25 then 'NON_FOLK' end as rejection_code from b""")
def relevance_gate(spark, d):
    """The whole relevance gate; the second model is called in tasks, for vectors of the undecided band."""
    s = _similarity(spark, d).withColumn("second", _second(relevance.undecided(F.col("sim")), F.col("vec_id")))
    s = s.withColumn("sim", relevance.blend(F.col("sim"), F.col("second"))).withColumn("r", relevance.relevance_result(F.col("sim")))
    score = F.coalesce("r.score", F.round("sim", 4)) + 0.0
    return s.select("vec_id", score.alias("score"), "r.decision", "r.rejection_code")


@query("""select case page_id % 3 when 0 then substr(md5(url), 1, 11) when 1 then substr(md5(url), 1, 11) else url end as recording_id, 'pages' as category_slug, '' as title
  from pages""")
def address_candidates(spark, d):
    short = F.substring(F.md5("url"), 1, 11)
    p = F.col("page_id") % 3
    u = F.when(p == 0, F.concat(F.lit(" https://m.example/watch?v="), short)).when(p == 1, short).otherwise(F.col("url"))
    return chain.address_candidates(t(spark, d, "pages").select(u.alias("url")), "pages").select("recording_id", "category_slug", "title")


def _wav(rows: DataFrame) -> Column:
    """Bytes of an 8-bit mono file of 8000 samples a second: the text's own bytes as samples, a fifth of them cut off for every seventh text."""
    little = lambda n, width: F.unhex(F.concat(*(F.lpad(F.hex(F.shiftright(n, 8 * i).bitwiseAND(F.lit(255))), 2, "0") for i in range(width))))
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    n = F.octet_length(data)
    head = bytes.fromhex("57415645666d74201000000001000100401f0000401f00000100080064617461")
    held = F.when(F.col("doc_id") % 7 == 0, F.substring(data, F.lit(1), F.floor(n * 0.8).cast("int"))).otherwise(data)
    return F.concat(F.lit(b"RIFF"), little(n + 36, 4), F.lit(head), little(n, 4), held)


@query("""with n as (select doc_id, octet_length(encode(coalesce(text, '')))::bigint as n from documents), f as (select *, if(doc_id % 7 = 0, floor(n * 0.8), n)::bigint as held from n)
  select doc_id, held as frames, n / 8000.0::double as container, held / 8000.0::double as pcm, case when held = 0 or abs(n - held) / 8000.0 > greatest(1, 0.15 * n / 8000.0) then 'CORRUPT_AUDIO' end as code from f""")
def container_probe(spark, d):
    """Files whose headers are parsed: the facts come from their bytes, the code from the facts."""
    docs = t(spark, d, "documents")
    probed = container.probe(docs.select(F.col("doc_id").cast("string").alias("path"), _wav(docs).alias("content")))
    code = gates.integrity_code(*(F.col("probe")[k] for k in chain.PROBE))
    return probed.select(F.col("path").cast("long").alias("doc_id"), "probe.frames", "probe.container", "probe.pcm", code.alias("code"))


TUNED_PAGES = 8  # about 3.5 MB of samples


@cache
def _beats(rate: int, gain: float) -> list[bytes]:
    """A quarter of a second for each byte of a digest: two of the 37 tones of which all tunes are made."""
    beat = np.arange(rate // 4) / rate
    tones = [np.sin(2 * np.pi * 110 * 2 ** (k / 12) * beat) for k in range(37)]
    return [audio.pcm_16((tones[b % 36] + 0.5 * tones[b // 7]) * gain) for b in range(256)]


def _tunes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each page a tune of its address and the same one again, quieter and at another rate; a few pages at a time."""
    for batch in batches:
        for at in range(0, len(batch), TUNED_PAGES):
            rows = []
            for page, digest in batch[["page_id", "digest"]].iloc[at : at + TUNED_PAGES].itertuples(index=False, name=None):
                for again, (rate, gain) in enumerate(((11025, 0.5), (16000, 0.1))):
                    beats = _beats(rate, gain)
                    rows.append((str(2 * page + again), audio.encode_wav(b"".join([beats[b] for b in digest]), rate)))
            yield pd.DataFrame(rows, columns=["path", "content"])


# The rule itself: what sounds the same is found, what doesn't is kept.
@query("""select 2 * page_id + again as ord, case when again = 1 then 2 * page_id end as duplicate_of from pages, (values (0), (1)) v(again)""")
def acoustic_duplicates(spark, d):
    """Prints of recordings, and the duplicates among them across gain and rate."""
    pages = t(spark, d, "pages")
    tasks = 1 + pages.count() // 128  # samples take time and room, rows don't
    made = pages.select("page_id", F.unhex(F.sha2(F.concat_ws(":", "page_id", "url"), 256)).alias("digest")).repartition(tasks)
    # Files are printed where they are made: their bytes stay in the worker. Prints are small, so fewer tasks read them.
    found = dedupe._checkpoint(made.mapInPandas(lambda batches: prints.printed(_tunes(batches)), prints.PRINTED)).coalesce(1 + tasks // 16)
    return dedupe.greedy(found.select(F.col("path").cast("long").alias("ord"), F.col("fingerprint").alias("fp")), 0.90)


@query("""with r as (select user_id, event_id, value >= 50 as later, event_type from events)
  select user_id::varchar as recording_id, arg_max(event_type, (later, event_id)) as decision, arg_max(event_id, (later, event_id)) as event_id from r group by 1""")
def runlog_transactions(spark, d):
    """A log of two transactions, the first of which is tried again and adds nothing, read back: its last lines with their open field."""
    folder = f"{dedupe.shared_folder(spark)}/log-{uuid.uuid4().hex}"
    rows = t(spark, d, "events").select(F.col("user_id").cast("string").alias("recording_id"), F.col("event_type").alias("decision"), "event_id", "value")
    for name, part in (("low", "value < 50"), ("high", "value >= 50"), ("low", "value < 50")):
        runlog.append_run_log(rows.where(part).drop("value").orderBy("event_id"), folder, name)
    read = runlog.read_run_log(spark, folder)
    return read.select("recording_id", "decision", F.try_variant_get(F.col("extra")["event_id"], "$", "bigint").alias("event_id"))


CHAIN_RULES = gates.TextRules(foreign_script="[ß]", foreign_terms=("eaux",), target_script="[éèêç]", context_terms=("the", "and", "de", "der", "a"),
                              exclusions={"SPEECH": ("whether",), "NEWS": ("tion",)})
_HEARD = "(code is null and quality >= 0.55)"
# The gates in order up to the classifier; then one pass in order over the prints that get that far; then the final rules.
_CHAIN = f"""with recursive labelled as (select doc_id from labels where quality = 1),
  src as (select *, n_chars / 10.0::double as dur, 55 + n_chars % 45 as best from documents where doc_id not in (select doc_id from labelled)),
  m as (select *, round(least(1, greatest(0, 1 - n_chars % 50 / 100.0 / 0.45)) * 0.18 + least(1, greatest(0, 1 - n_chars % 6 / 100.0 / 0.05)) * 0.14
    + least(1, greatest(0, (4 + n_chars % 30 - 5) / 25.0)) * 0.18 + least(1, greatest(0, (-25 - (-60 + n_chars % 37)) / 30.0)) * 0.12
    + least(1, greatest(0, (3 + n_chars % 40 - 4) / 36.0)) * 0.12 + least(1, greatest(0, 1 - n_chars % 12 / 100.0 / 0.1)) * 0.10
    + least(1, greatest(0, (2900 + n_chars % 5000) / 8000.0)) * 0.10
    + case when n_chars % 9 = 0 then 0.7 when -(n_chars % 50) between -45 and -4 then 1 else 0.4 end * 0.06, 4) as quality,
    case when n_chars % 7 = 0 then null else (n_chars % 100) / 100.0::double end as sim, case when n_chars % 5 = 0 then null else (n_chars % 90) / 100.0::double end as mus,
    (n_chars % 101) / 100.0::double as spe, (n_chars % 101) / 100.0::double as voc, {_OVERRIDE} as override from src),
  g as (select *, case
    when regexp_matches(text, '[ß]') or regexp_matches(lower(text), {_B('eaux')}) then 'metadata_gate:NON_FOLK'
    when not regexp_matches(text, '[éèêç]') and not regexp_matches(lower(text), {_B('the|and|de|der|a')}) then 'metadata_gate:NON_FOLK'
    when regexp_matches(lower(text), {_B('whether')}) and lang <> 'fr' then 'metadata_gate:SPEECH'
    when regexp_matches(lower(text), {_B('tion')}) then 'metadata_gate:NEWS'
    when best < 62 then 'metadata_gate:NON_FOLK'
    when dur > 300 then 'metadata_gate:TOO_LONG' when n_chars > 0 and dur < 10 then 'metadata_gate:TOO_SHORT'
    when {_BROKEN} then 'integrity_gate:CORRUPT_AUDIO'
    when dur < 10 then 'quality_gate:TOO_SHORT' when n_chars % 50 > 45 then 'quality_gate:MOSTLY_SILENT' when n_chars % 40 < 1 then 'quality_gate:SEVERE_DISTORTION'
    when n_chars % 30 < 1 then 'quality_gate:VERY_LOW_SNR' when -60 + n_chars % 37 > -25 then 'quality_gate:EXCESSIVE_NOISE' when n_chars % 12 > 10 then 'quality_gate:AUDIO_DROPOUT'
    when n_chars % 5000 < 100 then 'quality_gate:LOW_BANDWIDTH' end as code from m),
  h as (select * exclude (code, sim, mus, spe, voc), {_HEARD} as heard, case when {_HEARD} and sim < 0.25 then 'folk_relevance_gate:NON_FOLK' else code end as code,
    case when {_HEARD} then sim end as sim, case when {_HEARD} then mus end as mus, case when {_HEARD} then spe end as spe, case when {_HEARD} then voc end as voc from g),
  b as (select doc_id as vec_id, list_transform(embedding, lambda x: (x > 0)::int) as b from h join embeddings on vec_id = doc_id // 4 where heard and code is null),
  pairs as (select x.vec_id as ord, y.vec_id as other from b x join b y on y.vec_id < x.vec_id
    where 1 - list_sum(list_transform(range(1, 65), lambda i: xor(x.b[i], y.b[i]))) / 64.0::double >= 0.70),
  n as (select vec_id, row_number() over (order by vec_id) as i from b),
  near as (select n.i, n.vec_id, list(p.other) as others from n left join pairs p on p.ord = n.vec_id group by 1, 2),
  pass as (select 0 as i, []::bigint[] as kept union all
    select near.i, case when len(list_intersect(kept, others)) > 0 then kept else list_append(kept, near.vec_id) end from pass join near on near.i = pass.i + 1),
  last as (select kept from pass order by i desc limit 1),
  u as (select h.* exclude (code), case when code is null and doc_id in (select vec_id from b) and not list_contains(kept, doc_id)
    then 'duplicate_gate:DUPLICATE_RECORDING' else code end as code from h cross join last),
  f as (select *, case when code is null then {_SCORE.replace('relevance', 'sim').replace('music', 'mus').replace('speech', 'voc')} end as final_score,
    case when mus >= 0.25 and mus >= spe then 'SONG' when spe >= 0.85 and spe > mus then 'SPEECH' when mus >= 0.25 and spe >= 0.25 then 'MIXED' else 'UNKNOWN' end as label from u),
  z as (select *, case when code is not null then code when quality < 0.55 then 'final_scoring:' || override
    when label = 'SPEECH' and coalesce(mus, 0) < 0.25 and (case when lang = 'fr' then spe > 0.92 else spe >= 0.85 end) then 'final_scoring:SPEECH'
    when mus < 0.25 and sim < 0.4 then 'final_scoring:NON_SONG' when final_score < 0.4 and sim < 0.4 then 'final_scoring:NON_FOLK'
    when final_score < 0.4 then 'final_scoring:NON_SONG' end as done from f)
  select doc_id, coalesce(string_split(done, ':')[1], 'final_scoring') as stage, case when done is not null then 'REJECT'
    when best < 70 or (heard and (sim is null or sim < 0.35)) or final_score < 0.5 then 'REVIEW' else 'ACCEPT' end as decision,
    string_split(done, ':')[2] as rejection_code, final_score + 0.0 as final_score from z"""


def _heard_signals(rows: DataFrame) -> DataFrame:
    """Stand-ins for the models, over the length that the metrics hold."""
    n = F.round(F.col("metrics.duration") * 10).cast("long")
    return rows.withColumns({"music": F.when(n % 5 != 0, (n % 90) / 100.0), "speech": (n % 101) / 100.0, "vocal": (n % 101) / 100.0,
                             "similarity": F.when(n % 7 != 0, (n % 100) / 100.0)})


@query(_CHAIN)
def candidate_chain(spark, d):
    """The whole chain: documents that no log holds, every gate in order, duplicates among what gets that far, the final decision."""
    log = t(spark, d, "labels").where("quality = 1").select(F.col("doc_id").alias("recording_id"))
    prints = _prints(spark, d).withColumnRenamed("ord", "vec_id")
    rows = t(spark, d, "documents").select(
        F.col("doc_id").alias("recording_id"), F.col("source").alias("category_slug"), F.col("doc_id").alias("ord"), F.col("text").alias("raw"),
        (F.col("lang") == "fr").alias("narration"), (55 + F.col("n_chars") % 45).cast("double").alias("best"), F.lit(1).alias("hits"),
        (F.col("n_chars") / 10.0).alias("duration"), F.struct(*(v.alias(k) for k, v in _probe().items())).alias("probe"),
        F.struct(*(v.alias(k) for k, v in _metrics().items())).alias("metrics"),
    )
    own = settings.Settings(duplicate_similarity=0.70)
    screened = chain.screen(rows, CHAIN_RULES, own).drop("raw", "probe")  # texts stay where they were read
    todo = chain.pending(screened, log, log.limit(0)).join(prints, F.expr("recording_id div 4 = vec_id"), "left").drop("vec_id")  # four documents share a print
    decided = chain.decide(todo, CHAIN_RULES, _heard_signals, s=own)
    return decided.select(F.col("recording_id").alias("doc_id"), "stage", "decision", "rejection_code", (F.col("final_score") + 0.0).alias("final_score"))


_FINE = {"duration": 60.0, "silence": 0.0, "clipping": 0.0, "dynamic_range": 30.0, "snr": 30.0, "noise_floor": -60.0, "dropout": 0.0, "rolloff": 8000.0, "sample_rate": 44100.0, "lufs": -14.0}


# One document in four is split into two to four parts; one in nine can't be fetched, one in thirteen is broken.
@query(f"""with first as (select doc_id, n_chars, coalesce('metadata_gate:' || {_TEXT_CASE}, case when n_chars / 10.0 > 300 then 'metadata_gate:TOO_LONG' when n_chars > 0 and n_chars / 10.0 < 10 then 'metadata_gate:TOO_SHORT'
    when doc_id % 9 = 0 then 'download:DOWNLOAD_FAILED' when doc_id % 13 = 0 then 'integrity_gate:CORRUPT_AUDIO' end) as code from documents),
  parts as (select doc_id, n_chars, code, unnest(case when code is null and doc_id % 4 = 1 then range(doc_id % 3 + 2) else [null] end) as piece from first),
  judged as (select doc_id, piece, coalesce(code, case when (n_chars + 17 * coalesce(piece, 0)) % 50 > 45 then 'quality_gate:MOSTLY_SILENT' else 'final_scoring' end) as code from parts),
  rows as (select doc_id::varchar || case when piece is null then '' else printf('_p%02d', piece + 1) end as recording_id, code from judged
    union all select doc_id::varchar, case when bool_or(code = 'final_scoring') then 'chunking' else 'chunking:' end from judged where piece is not null group by doc_id)
  select recording_id, string_split(code, ':')[1] as stage, case when contains(code, ':') then 'REJECT' else 'ACCEPT' end as decision, nullif(string_split(code, ':')[2], '') as rejection_code from rows""")
def chain_with_parts(spark, d):
    """The chain with what can't be fetched, and with long recordings that stand as their parts."""
    c = F.col
    metrics = lambda silence: F.struct(*((silence if k == "silence" else F.lit(v)).alias(k) for k, v in _FINE.items()))
    here = c("doc_id") % 13 != 0
    probe = F.struct(*(v.alias(k) for k, v in {"exists": here, "size": F.lit(9), "frames": F.lit(9), "has_stream": here, "container": F.lit(60.0), "pcm": F.lit(60.0)}.items()))
    docs = t(spark, d, "documents")
    rows = docs.select(
        c("doc_id").cast("string").alias("recording_id"), c("source").alias("category_slug"), c("doc_id").alias("ord"), c("text").alias("raw"), (c("source") == "src1").alias("narration"),
        F.lit(90.0).alias("best"), F.lit(1).alias("hits"), (c("n_chars") / 10.0).alias("duration"), (c("doc_id") % 9 != 0).alias("fetched"), probe.alias("probe"),
        metrics(c("n_chars") % 50 / 100.0).alias("metrics"), F.lit(None).cast("array<bigint>").alias("fp"), F.lit(0.9).alias("music"), F.lit(0.1).alias("speech"), F.lit(0.8).alias("vocal"), F.lit(0.6).alias("similarity"),
    )
    pieces = docs.where("doc_id % 4 = 1").select(c("doc_id").cast("string").alias("recording_id"), "n_chars", F.explode(F.expr("sequence(0, int(doc_id % 3) + 1)")).alias("piece"))
    pieces = pieces.select("recording_id", "piece", metrics((c("n_chars") + 17 * c("piece")) % 50 / 100.0).alias("metrics"))
    return chain.decide(rows, RULES, pieces=pieces).select("recording_id", "stage", "decision", "rejection_code")
