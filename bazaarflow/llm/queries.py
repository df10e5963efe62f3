"""One query per operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarflow.llm import chat, filter_audit, fingerprints, language, license_scan, merkle, packing, pii, set_join, token_files, toxicity
from bazaarflow.llm.byte_pieces import byte_pieces
from bazaarflow.llm.exact_index import exact_copies
from bazaarflow.llm.registry import QUERIES, SQL, registered
from bazaarflow.sources.scratch import working_folder
from bazaarflow.sources.tables import table

__all__ = ["QUERIES", "SQL"]

STRIPPED = "regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')"


@registered(
    f"""with d as (select *, {STRIPPED} as body, length(coalesce(text, '')) as n from documents)
    select doc_id, first_value(doc_id) over w as keep_id, count(*) over (partition by body) as group_size,
      row_number() over w = 1 as kept, sha256(body) as text_sha256
    from d window w as (partition by body order by n desc, doc_id nulls last)"""
)
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_copies(table(spark, sf_dir, "documents")).drop("same_text")


@registered()
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(packing.token_pieces(table(spark, sf_dir, "documents"), vocabulary)).drop("row")


@registered()
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_pieces(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, with_ids=False)


@registered()
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    parser = language.train(docs.where(~language.held_out()))
    return language.detect(docs.select("doc_id", language.held_out().alias("held_out"), "text"), parser).drop("text")


@registered()
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_join.similar_components(table(spark, sf_dir, "documents")).drop("kept", "same_text")


@registered()
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.with_spans(docs, pii.train(docs))
    base = F.col("base_spans")
    return found.select(
        "doc_id",
        *[pii.count_of(base, kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(pii.spans_text(base), 256).alias("base_sha256"),
        pii.spans_text(F.concat("base_spans", "added_spans")).alias("spans"),
    )


@registered()
def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compared_with_edits(table(spark, sf_dir, "documents"))


ESCAPED = "replace(replace(replace(coalesce({0}, ''), '\\', '\\s'), '<', '\\l'), '[', '\\b')"


@registered(
    f"""with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
      union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]')
    select conv_id, count(*) as n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
      cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
      sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
      cast(sum(length({ESCAPED.format("role")}) + length({ESCAPED.format("text")}) + {len(chat.TURN + chat.TEXT + chat.END)}) as bigint) as formatted_chars
    from t group by conv_id"""
)
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    told = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(told).alias("text"),
    )
    formatted = chat.format_chats(turns.unionByName(more).withColumn("parts", chat.text_part(F.col("text"))))
    read = formatted.withColumn("turns", chat.turns_of(F.col("formatted"))).withColumn("learned", chat.loss_text(F.col("formatted"), F.col("loss")))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@registered()
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels"))).drop("text")


@registered()
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents lie in folders by source and number; a short one with a notice is the licence file of its folder, some of the one above or of the source."""
    docs = table(spark, sf_dir, "documents")
    # Short documents lie in folders of three levels.
    level = F.when(F.length("text") < 400, F.pmod("doc_id", F.lit(3)))
    name = F.concat_ws(
        "/", F.coalesce("source", F.lit("none")), F.when(level.isNull() | (level > 0), F.expr("doc_id div 10000")),
        F.when(level.isNull() | (level > 1), F.expr("doc_id div 100")), "doc_id",
    )
    files = docs.select("doc_id", "text", name.alias("path"))
    found = license_scan.licences(files, licence_file=F.length("text") < 400)
    return found.withColumn("doc_id", F.element_at(F.split("path", "/"), -1).cast("long"))


LEAF = "sha256(" + " || ".join(
    f"coalesce(strlen(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')" for c in ("doc_id", "source", "lang", "n_chars", "{0}")
) + ")"
#: CRC-32 of the decimal id, by its reflected polynomial.
CRC = (
    "xor(4294967295, list_reduce(list_transform(string_split(cast(doc_id as varchar), ''), lambda x: cast(ord(x) as bigint)), "
    "lambda c, b: list_reduce(range(8), lambda v, i: xor(v >> 1, 3988292384 * (v & 1)), xor(c, b)), 4294967295))"
)


def _tree(name: str, leaves: str) -> str:
    """Nodes of all levels with the siblings before and after, from leaves (grp, rank, n, digest)."""
    run = "order by rank rows between {} and {}"
    before, after = run.format("unbounded preceding", "1 preceding"), run.format("1 following", "unbounded following")
    return f"""{name}(level, grp, rank, n, digest) as (
      select 0, grp, rank, n, digest from ({leaves})
      union all select level + 1, grp, rank // 3, (n + 2) // 3, sha256(string_agg(digest, '' order by rank))
      from {name} where n > 1 group by level, grp, rank // 3, n),
    {name}_runs as (select *, coalesce(string_agg(digest, '') over (partition by level, grp, rank // 3 {before}), '') as before,
      coalesce(string_agg(digest, '') over (partition by level, grp, rank // 3 {after}), '') as after from {name} where n > 1)"""


def _climb(name: str, start: str, runs: str) -> str:
    """Every start (doc_id, grp, rank, folded, siblings) taken up level by level."""
    return f"""{name}(doc_id, level, grp, rank, folded, siblings) as (
      select doc_id, 0, grp, rank, folded, siblings from ({start})
      union all select c.doc_id, c.level + 1, c.grp, c.rank // 3, sha256(r.before || c.folded || r.after), c.siblings || r.before || r.after
      from {name} c join {runs} r on r.level = c.level and r.grp = c.grp and r.rank = c.rank),
    {name}_top as (select doc_id, grp, arg_max(folded, level) as folded, arg_max(siblings, level) as siblings from {name} group by doc_id, grp)"""


@registered(
    f"""with recursive leaves as (select doc_id, coalesce('1' || source, '0') as grp, {LEAF.format("text")} as leaf,
      case when {CRC} % 2 = 0 then {LEAF.format("replace(text, chr(10), '')")} else {LEAF.format("text")} end as given from documents),
    ranked as (select *, row_number() over (partition by grp order by doc_id, leaf) - 1 as rank, count(*) over (partition by grp) as n from leaves),
    {_tree("tree", "select grp, rank, n, leaf as digest from ranked")},
    subroots as (select grp, digest, row_number() over (order by grp) - 1 as rank, count(*) over () as n from tree where n = 1),
    {_tree("upper", "select '' as grp, rank, n, digest from subroots")},
    {_climb("climb", "select doc_id, grp, rank, given as folded, '' as siblings from ranked", "tree_runs")},
    {_climb("rest", "select c.doc_id, '' as grp, s.rank, c.folded, c.siblings from climb_top c join subroots s using (grp)", "upper_runs")}
    select d.doc_id, d.leaf, s.digest as subroot, u.digest as root, sha256(t.siblings) as proof_sha256, t.folded as folded_root, t.folded = u.digest as verified
    from ranked d join subroots s using (grp) join rest_top t using (doc_id) cross join (select digest from upper where n = 1) u"""
)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    values = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    # Tampering deletes line ends; a null id counts as an empty text. Most texts stay as they are.
    tampered = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 2 == 0
    plain = F.replace("text", F.lit("\n"), F.lit(""))
    leaves = docs.select(
        "doc_id", "source", merkle.leaf_of(*values, F.col("text")).alias("leaf"),
        F.when(tampered & F.col("text").contains("\n"), merkle.leaf_of(*values, plain)).alias("given"),
    )
    found = merkle.manifest(leaves, "source", ["doc_id"], "leaf")
    again = found.withColumn("folded_root", merkle.folded(F.col("path"), F.coalesce("given", "leaf")))
    return again.select(
        "doc_id", "leaf", "subroot", "root", merkle.siblings_digest(F.col("path")).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


@registered(
    """with words as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
        list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as ws from documents),
    marked as (select doc_id, part,
        case when len(ws) < 200 then 'A' else '' end || case when 100 * len(list_distinct(ws)) < 50 * len(ws) then 'B' else '' end
        || case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) then 'C' else '' end
        || case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end
        || case when doc_id > min(doc_id) over (partition by t) then 'E' else '' end as fails from words),
    told as (select doc_id, max(quality = 1) as good, max(toxic = 1) as toxic from labels group by doc_id),
    combined as (select part, fails, coalesce(good, false) as good, coalesce(toxic, false) as toxic, count(*) as n
        from marked left join told using (doc_id) group by all),
    letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as l),
    orders as (select a.l || b.l || c.l || d.l || e.l as filter_order from letters a, letters b, letters c, letters d, letters e
        where len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
    steps as (select filter_order, step, filter_order[step] as f, filter_order[1:step - 1] as earlier from orders, range(1, 6) s(step)),
    each as (select *, contains(fails, f) as failing, regexp_matches(fails, '[' || earlier || '-]') as gone from combined, steps),
    counts as (select part, filter_order, cast(step as int) as step, f,
        coalesce(sum(n) filter (not failing and not gone), 0) as kept, coalesce(sum(n) filter (failing and not gone), 0) as removed,
        coalesce(sum(n) filter (failing and gone), 0) as redundant, coalesce(sum(n) filter (fails = f), 0) as unique_fails,
        coalesce(sum(n) filter (failing and not gone and good), 0) as good_lost, coalesce(sum(n) filter (failing and not gone and toxic), 0) as toxic_lost
        from each group by all)
    select part, filter_order, step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant, unique_fails::bigint as unique_fails,
        good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost, (sum(removed) over (partition by part, f))::bigint as shapley from counts"""
)
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = filter_audit.failed_filters(table(spark, sf_dir, "documents"))
    return filter_audit.audit(filter_audit.labelled(failed, table(spark, sf_dir, "labels")))


@registered()
def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the files below the shared working folder and reads them back."""
    folder = working_folder(spark, "token-files")
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    width = token_files.width_of(vocabulary)
    token_files.write_tokens(token_files.tokens(table(spark, sf_dir, "documents"), vocabulary, width=width), folder, width)
    return token_files.read_tokens(spark, folder, with_ids=False)
