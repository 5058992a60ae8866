import subprocess
import sys
from pathlib import Path

import public_tokenizers
from conftest_llm import EDGES, SMALL
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from flowspark.llm import langid, quality
from flowspark.llm.common import words_of
from flowspark.llm.decontaminate import windows
from flowspark.llm.lm_scoring import score_texts
from test_dart_minhash import classes_by_brute_force

ROOT = Path(__file__).resolve().parents[2]


def test_stages_and_run_equal_brute_force(spark):
    """run() as a whole against the stages' decisions taken row by row in plain Python. Quality and language are decided
    by the fitted models themselves, which `test_quality_and_language` holds against plain code."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels, benchmark = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("labels", "benchmark"))
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}

    forest = quality.learn(docs, labels)
    left = {i: t for i, t in rows.items() if quality.scores(forest, [t])[0] >= 0.3}
    model = langid.learn(docs.where(docs.doc_id.isin(list(left))))
    left = {i: t for i, t in left.items() if not model.predict(t)[2]}
    first = {least for _, least, _, _ in classes_by_brute_force(list(left.items()))}
    left = {i: t for i, t in left.items() if i in first}
    tests = {w for r in benchmark.collect() for w in windows(words_of(r["text"]), 10)}
    lengths = {len(w) for w in tests}
    hit = lambda ws: any(tuple(ws[i : i + n]) in tests for n in lengths for i in range(len(ws) - n + 1))
    left = {i: t for i, t in left.items() if not hit(words_of(t))}

    pieces = corpus_pipeline.run(spark, SMALL).collect()
    assert {r["doc_id"] for r in pieces} == set(left) and 0 < len(left) < len(rows)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sizes = {}
    for r in pieces:
        sizes[r["doc_id"]] = sizes.get(r["doc_id"], 0) + r["length"]
    assert sizes == {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in left.items()}


def test_stages_keep_the_columns(spark, docs):
    table = docs(EDGES)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, table, SMALL)
        assert kept.columns == table.columns, name
        assert kept.count() <= len(EDGES)
        assert stage(spark, docs([]), SMALL).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs([]), SMALL).count() == 0


def test_stages_take_any_columns_and_ids(spark):
    """Dotted and repeated-looking names, ids of other types."""
    texts = [(i, t) for i, t in EDGES if i is not None][:6]
    for kind in ("smallint", "decimal(10,0)", "string", "binary"):
        table = spark.createDataFrame([(str(i), t, "en", 1, "s") for i, t in texts], "doc_id string, text string, lang string, `a.b` int, c0 string")
        table = table.withColumn("doc_id", table.doc_id.cast(kind))
        for name, stage in corpus_pipeline.STAGES[:-1]:
            if name != "quality classifier" or kind != "binary":
                kept = stage(spark, table, SMALL)
                assert kept.columns == table.columns and kept.dtypes == table.dtypes, (name, kind)
                kept.collect()
        assert corpus_pipeline.STAGES[-1][1](spark, table, SMALL).dtypes[0] == ("doc_id", kind)
        assert score_texts(table).select("doc_id").dtypes == [("doc_id", kind)]
        assert score_texts(table).count() == len(texts)


def test_run_reads_each_stage_once(spark, monkeypatch):
    """Every stage but the last is written once and read from there."""
    seen = []

    def counting(name, stage):
        def run(spark, docs, sf_dir):
            seen.append((name, [f for f in docs.inputFiles() if "stage-" in f or "documents" in f]))
            return stage(spark, docs, sf_dir)

        return run

    monkeypatch.setattr(corpus_pipeline, "STAGES", [(n, counting(n, s)) for n, s in corpus_pipeline.STAGES])
    corpus_pipeline.run(spark, SMALL)
    folders = [{f.rsplit("/", 1)[0] for f in files} for _, files in seen]
    assert all(len(f) == 1 for f in folders) and len({*map(tuple, folders)}) == 5


def test_the_entry_works_without_a_library_of_this_part():
    """Without the subpackage, the pipeline or a library that only they use, the other queries are there."""
    for gone in ("public_tokenizers", "ahocorasick", "tokenizers", "flowspark.llm", "corpus_pipeline", "regex"):
        code = f"import sys; sys.modules['{gone}'] = None; import __spark_entry__ as e; q = e.queries(); print(len(q), 'op1_lm_scoring' in q, 'aws_instances' in q)"
        out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=60)
        assert out.stdout.split()[1:] == ["False", "True"], (gone, out.stderr[-500:])


def test_registered():
    names = [n for n in queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in queries()
    assert set(oracle_sql()) <= set(queries())


def test_columns_of_the_contracts(spark):
    contracts = {
        1: "doc_id held_out n_tokens n_known train_tokens base_score score",
        3: "doc_id n_bytes n_tokens over_limit",
        4: "doc_id held_out score predicted",
        5: "doc_id n_words n_base first_word last_word base_labels labels score",
        6: "query_id rank vec_id score",
        8: "doc_id start length ids_crc32 doc_tokens sequence_id offset",
        9: "doc_id held_out lang_pred score",
        10: "doc_id n_words n_hit n_items items_sha256 contaminated",
        11: "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
        12: "doc_id leaf subroot root proof_sha256 folded_root verified",
        13: "item_id rank doc_id score",
    }
    for n, columns in contracts.items():
        query = next(q for name, q in queries().items() if name.startswith(f"op{n}_"))
        assert set(columns.split()) <= set(query(spark, SMALL).columns)
