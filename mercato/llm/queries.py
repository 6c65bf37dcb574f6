"""Registered queries of the training-data operators (see README)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLE[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def packed(docs: DataFrame) -> DataFrame:
    from mercato.llm.packing import pack

    pieces = pack(docs, tokenizer_path())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op1_pack")
def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


@query("op4_suffix_decontamination")
def op4_suffix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mercato.llm.decontam import decontaminate

    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


@query("op5_language_family")
def op5_language_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mercato.llm import langid

    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(langid.fold("doc_id", 5) != 0))
    held_out = (langid.fold("doc_id", 5) == 0).alias("held_out")
    return langid.predict(docs, model).select("doc_id", held_out, "lang_pred", "score")


def quality_model(docs: DataFrame, labels: DataFrame):
    """The discriminant fitted on the labelled documents outside fold 2 of 4."""
    from mercato.llm import langid, qda

    rows = labels.filter(langid.fold("doc_id", 4) != 2)
    return qda.fit(qda.labelled(qda.with_statistics(docs.filter(langid.fold("doc_id", 4) != 2)), rows))


@query("op6_quadratic_quality")
def op6_quadratic_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mercato.llm import langid, qda

    docs = table(spark, sf_dir, "documents")
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    scored = qda.score(qda.with_statistics(docs), model)
    return scored.select(
        "doc_id",
        (langid.fold("doc_id", 4) == 2).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
    )


@query("op7_license_index")
def op7_license_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mercato.llm import licenses

    docs = table(spark, sf_dir, "documents")
    found = licenses.scan(docs, licenses.word_weights(docs))
    names = "array_join(array_sort(array_distinct({})), ',')"
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.expr("array_min(transform(base, b -> b.start))").alias("first_word"),
        F.expr("array_max(transform(base, b -> b.start))").alias("last_word"),
        F.expr(names.format("transform(base, b -> b.label)")).alias("base_labels"),
        F.expr(names.format("concat(transform(base, b -> b.label), transform(found, f -> f.label))")).alias("labels"),
        "score",
    )


OP9_SQL = """
with t as (select conv_id::bigint conv_id, turn::bigint turn, role, text from conversations
           where conv_id is not null and turn is not null),
last as (select conv_id, turn last_turn, text from (
           select conv_id, turn, coalesce(text, '') as text,
                  row_number() over (partition by conv_id order by turn desc, coalesce(text, '') desc) k
           from t where role = 'assistant') where k = 1),
sides as (
  select conv_id pair_id, 'chosen' side, turn, role, text from t
  union all
  select t.conv_id, 'rejected', t.turn, t.role, t.text from t left join last on t.conv_id = last.conv_id
  where last.last_turn is null or not (t.turn = last.last_turn and t.role is not distinct from 'assistant')
  union all
  select a.conv_id, 'rejected', a.last_turn, 'assistant', b.text from last a join last b on b.conv_id = a.conv_id + 1),
clean as (select distinct pair_id, side, turn, coalesce(role, 'unknown') as role, coalesce(text, '') as text from sides),
placed as (select *, row_number() over (partition by pair_id, side, turn order by role, text) - 1 as place from clean),
c as (select * from placed where side = 'chosen'),
r as (select * from placed where side = 'rejected'),
both_sides as (
  select coalesce(c.pair_id, r.pair_id) pair_id, coalesce(c.turn, r.turn) turn, coalesce(c.place, r.place) place,
         c.role c_role, c.text c_text, r.role r_role, r.text r_text
  from c full join r on c.pair_id = r.pair_id and c.turn = r.turn and c.place = r.place),
split as (select pair_id, turn s_turn, place s_place from (
            select pair_id, turn, place, row_number() over (partition by pair_id order by turn, place) k from both_sides
            where c_role is distinct from r_role or c_text is distinct from r_text) where k = 1),
marked as (select b.*, s_turn is null or b.turn < s_turn or (b.turn = s_turn and b.place < s_place) as in_prompt
           from both_sides b left join split on b.pair_id = split.pair_id),
out as (
  select pair_id, case when in_prompt then 'prompt' else 'chosen' end as segment, turn, place, c_role as role, c_text as text
  from marked where c_role is not null
  union all
  select pair_id, 'rejected', turn, place, r_role, r_text from marked where r_role is not null and not in_prompt)
select pair_id, segment, turn, place::bigint as place, role,
       concat('<|', role, '|>', chr(10), text, chr(10)) as content,
       role = 'assistant' and segment <> 'prompt' as trained
from out
"""


@query("op9_preference_format", OP9_SQL)
def op9_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mercato.llm.chat import preference_turns, with_borrowed_replies

    both = with_borrowed_replies(table(spark, sf_dir, "conversations"))
    return preference_turns(both, F.col("conv_id"), F.col("chosen"))


@query("op3_likelihood_ratio_rules")
def op3_likelihood_ratio_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mercato.llm import quality_rules as rules

    docs = table(spark, sf_dir, "documents")
    ratios = rules.log_ratios(rules.bucket_counts(docs, table(spark, sf_dir, "labels")))
    return rules.score(docs, ratios)


@query("op2_mincut_text")
def op2_mincut_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mercato.llm.html import extract

    text = extract(table(spark, sf_dir, "pages"))
    return text.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_blocks", "n_kept")


@query("op8_minmax_near_duplicates")
def op8_minmax_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mercato.llm.minmax import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


@query("op10_paragraph_minhash")
def op10_paragraph_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mercato.llm.paragraphs import dedup_paragraphs

    return dedup_paragraphs(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
with d as (select doc_id, coalesce(text, '') t, sha256('7:' || coalesce(doc_id::varchar, '')) h from documents),
u as (select *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') us from d),
c as (select *, len(us) n, ('0x' || substr(h, 1, 8))::bigint % (len(us) + 1) c1, ('0x' || substr(h, 9, 8))::bigint % (len(us) + 1) c2,
             case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>')
                       or ('0x' || substr(h, 17, 8))::bigint % 100 >= 100 then 'plain'
                  when ('0x' || substr(h, 25, 8))::bigint % 100 < 50 then 'spm' else 'psm' end form from u),
s as (select *, array_to_string(us[:least(c1, c2)], '') p, array_to_string(us[least(c1, c2) + 1:greatest(c1, c2)], '') m,
             array_to_string(us[greatest(c1, c2) + 1:], '') s from c)
select doc_id, n::bigint n, form, case when form <> 'plain' then length(p)::bigint end prefix_chars,
       case when form <> 'plain' then length(m)::bigint end middle_chars,
       sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
                        else '<S>' || s || '<P>' || p || '<M>' || m end) output_sha256,
       sha256(t) restored_sha256
from s
"""


@query("op13_learned_rank_fim", OP13_SQL)
def op13_learned_rank_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mercato.llm.fim import fill_in_middle

    cut = fill_in_middle(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("text", 256).alias("restored_sha256"),
    )


OP11_SQL = """
with d as (select row_number() over () r, doc_id, coalesce(text, '') t from documents),
l as (select r, unnest(string_split(t, chr(10))) line, unnest(range(len(string_split(t, chr(10))))) pos from d),
k as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') key from l),
hot as (select key from k where length(key) >= 1 group by key having count(distinct r) >= 10),
m as (select k.*, hot.key is not null dropped from k left join hot on k.key = hot.key),
g as (select r, count(*) n_lines, count(*) filter (dropped) n_dropped,
             string_agg(line, chr(10) order by pos) filter (not dropped) kept from m group by r)
select doc_id, n_lines, n_dropped, sha256(coalesce(kept, '')) kept_sha256 from d join g on d.r = g.r
"""


@query("op11_cuckoo_line_dedup", OP11_SQL)
def op11_cuckoo_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mercato.llm.linededup import drop_common_lines

    kept = drop_common_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op12_checkpointed_repair")
def op12_checkpointed_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mercato.llm import repair
    from mercato.plans.joins import join_on_keys

    turns = table(spark, sf_dir, "conversations")
    repaired = repair.repair(repair.damaged(turns))
    every = turns.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    found = join_on_keys(repaired.conversations, repair.digests(repaired.edits), ["conv_id"])
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return join_on_keys(every, found, ["conv_id"]).select(
        "conv_id",
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"),
    )
