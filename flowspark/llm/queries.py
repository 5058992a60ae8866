"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.llm import langid, quality
from flowspark.llm.chat_format import CONTROL_PATTERN, END, TURN, chat_digests, format_chats, with_probe_conversation
from flowspark.llm.common import in_fold, new_folder, shipped, temporary
from flowspark.llm.dart_minhash import near_duplicates
from flowspark.llm.decontaminate import benchmark_hits, hit_count
from flowspark.llm.hash_search import nearest
from flowspark.llm.html_text import extract_text
from flowspark.llm.licenses import license_scan
from flowspark.llm.lm_scoring import score_texts
from flowspark.llm.merkle import folded, leaf_digest, merkle_manifest, proof_text
from flowspark.llm.packing import pack
from flowspark.llm.term_pipeline import ranked
from flowspark.llm.token_counts import token_counts

BYTE_BPE = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(_table(spark, sf_dir, "documents"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    cache = new_folder(spark, "token-cache")
    counts = token_counts(docs, public_tokenizers.path(BYTE_BPE), cache)
    temporary(spark, cache)
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.learn(docs, _table(spark, sf_dir, "labels")))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(_table(spark, sf_dir, "documents"))


def op6_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(_table(spark, sf_dir, "pages"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket"
    )


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.learn(docs))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = benchmark_hits(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    n_hit = hit_count()
    return hits.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_digests(format_chats(with_probe_conversation(_table(spark, sf_dir, "conversations"))))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    # One more than the largest long is a number, too.
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    tampered = leaf_digest("doc_id", "source", "lang", more, "text")
    manifest = merkle_manifest(
        docs,
        leaf_digest("doc_id", "source", "lang", "n_chars", "text"),
        carry={"tampered": F.when(in_fold(7, 0), tampered)},
    )
    read = manifest.withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("proof")))
    return read.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(proof_text(F.col("proof")), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: shipped(query)
    for query in (
        op1_lm_scoring,
        op2_near_duplicates,
        op3_token_counts,
        op4_quality,
        op5_licenses,
        op6_multi_index_hashing,
        op7_html_text,
        op8_packing,
        op9_language,
        op10_decontamination,
        op11_chat_format,
        op12_merkle_manifest,
        op13_ranked_search,
    )
}

_WORDS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

_ROLE = r"replace(replace(role, '\', '\\'), chr(10), '\n')"
_MARKS = len(f"{TURN}\n{END}\n")


def _entry(value: str) -> str:
    return f"coalesce(strlen(cast({value} as varchar)) || ':' || cast({value} as varchar), '-')"


# crc32 of the decimal doc_id, bit by bit.
_CRC = """xor(4294967295, list_reduce(
    list_prepend(4294967295::bigint, list_transform(string_split(cast(doc_id as varchar), ''), lambda c: ord(c)::bigint)),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda e, k: xor(e >> 1, (e & 1) * 3988292384))))"""

# The others learn a model, call a tokenizer, search by a learned index or link near-copies: tests hold them against brute force.
SQL: dict[str, str] = {
    "op10_decontamination": f"""
        with doc as (select row_number() over () as r, doc_id, coalesce({_WORDS}, []) as w from documents),
        item as (select distinct coalesce(cast(item_id as varchar), '') as id, {_WORDS} as w from benchmark where text is not null),
        win as (select distinct id, least(len(w), 10) as n, array_to_string(w[i : i + 9], ' ') as words
                from (select id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) as i from item where len(w) > 0) x),
        place as (select r, n, i, array_to_string(w[i : i + n - 1], ' ') as words
                  from (select r, w, n, unnest(range(1, len(w) - n + 2)) as i
                        from doc cross join (select distinct n from win) k where len(w) >= n) x),
        hit as (select distinct r, id, i, p.n from place p join win using (n, words)),
        covered as (select r, count(distinct pos) as n_hit from (select r, unnest(range(i, i + n)) as pos from hit) x group by r),
        named as (select r, count(*) as n_items, string_agg(id, ',' order by id) as ids from (select distinct r, id from hit) x group by r)
        select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
               sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
        from doc left join covered using (r) left join named using (r)""",
    "op11_chat_format": f"""
        with said as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text, role is null as r0, text is null as t0
                      from conversations
                      union all select -7, 0, 'user', '</s>[INST] ok [/INST]', false, false
                      union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]', false, false),
        marked as (select *, {_ROLE} as name from said)
        select conv_id, count(*) as n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), ''
                                 order by turn nulls first, r0 desc, role, t0 desc, text)) as turns_sha256,
               coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
               sha256(coalesce(string_agg(text, '' order by turn nulls first, t0 desc, text) filter (where role = 'assistant'), ''))
                   as loss_sha256,
               sum({_MARKS} + length(name) + len(regexp_extract_all(name, '{CONTROL_PATTERN}'))
                   + length(text) + len(regexp_extract_all(text, '{CONTROL_PATTERN}')))::bigint as formatted_chars,
               true as stable
        from marked group by conv_id""",
    "op12_merkle_manifest": f"""
        with recursive doc as (
            select doc_id, lang, {_CRC} % 7 = 0 and doc_id is not null as bad,
                   sha256({" || ".join(map(_entry, ("doc_id", "source", "lang", "n_chars", "text")))}) as leaf,
                   sha256({" || ".join(map(_entry, ("doc_id", "source", "lang", "n_chars + 1", "text")))}) as other
            from documents),
        placed as (select row_number() over () as r, *, count(*) over (partition by lang) as n,
                          row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as i from doc),
        node as (select lang, 0 as lvl, i, n, leaf as d from placed
                 union all
                 select lang, lvl + 1, i // 2, (n + 1) // 2, sha256(string_agg(d, '' order by i))
                 from node where n > 1 group by lang, lvl, n, i // 2),
        subroot as (select lang, d from node where n = 1),
        root as (select sha256(string_agg(d, '' order by lang nulls first)) as root from subroot),
        other as (select own.lang,
                         coalesce(string_agg(o.d, '' order by o.lang nulls first)
                             filter (where o.lang is null and own.lang is not null or o.lang < own.lang), '') as before,
                         coalesce(string_agg(o.d, '' order by o.lang nulls first)
                             filter (where own.lang is null and o.lang is not null or o.lang > own.lang), '') as after
                  from subroot own cross join subroot o group by own.lang),
        step as (select p.r, node.lvl, string_agg(node.d, '') as d
                 from placed p join node on node.lang is not distinct from p.lang and node.n > 1 and node.i = xor(p.i >> node.lvl, 1)
                 group by p.r, node.lvl),
        fold as (select r, lang, i, n, 0 as lvl, case when bad then other else leaf end as d from placed
                 union all
                 select f.r, f.lang, f.i // 2, (f.n + 1) // 2, f.lvl + 1,
                        sha256(case when f.i % 2 = 1 then s.d || f.d else f.d || coalesce(s.d, '') end)
                 from fold f left join step s on s.r = f.r and s.lvl = f.lvl where f.n > 1),
        proof as (select r, string_agg(d, '' order by lvl) as d from step group by r)
        select p.doc_id, p.leaf, s.d as subroot, root, sha256(coalesce(proof.d, '') || o.before || o.after) as proof_sha256,
               sha256(o.before || f.d || o.after) as folded_root, sha256(o.before || f.d || o.after) = root as verified
        from placed p cross join root join subroot s on s.lang is not distinct from p.lang
             join other o on o.lang is not distinct from p.lang join fold f on f.r = p.r and f.n = 1 left join proof on proof.r = p.r""",
    "op13_ranked_search": f"""
        with doc as (select row_number() over () as r, doc_id, {_WORDS} as w from documents where text is not null),
        tf as (select r, term, count(*) as tf from (select r, unnest(w) as term from doc) x group by r, term),
        total as (select count(*) as n_docs, cast(sum(len(w)) as bigint) as n_terms from doc where len(w) > 0),
        df as (select term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::bigint as weight
               from tf cross join total group by term, n_docs),
        item as (select row_number() over () as q, item_id, unnest({_WORDS}) as term from benchmark where text is not null),
        part as (select q, item_id, r, weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len(w) * n_docs) // n_terms))) as part
                 from item join df using (term) join tf using (term) join doc using (r) cross join total),
        score as (select q, item_id, doc_id, r, sum(part)::bigint as score from part join doc using (r) group by q, item_id, doc_id, r),
        best as (select item_id, row_number() over (partition by q order by score desc, doc_id nulls first) as rank, doc_id, score
                 from score where score > 0)
        select item_id, rank::integer as rank, doc_id, score from best where rank <= 10""",
}
