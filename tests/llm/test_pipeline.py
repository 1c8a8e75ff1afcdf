import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[2]), str(Path(__file__).resolve().parent)]

import corpus_pipeline  # noqa: E402
from tallybrook.llm.common import WordTokenizer, vocabulary_file  # noqa: E402
from tallybrook.llm.mixing import unit_draw  # noqa: E402
from test_mixing_sharding import brute_targets  # noqa: E402
from test_near_dups import brute_set, groups  # noqa: E402
from test_quality_toxicity import brute_counts, junk  # noqa: E402

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, length long, node long, row int"


@pytest.fixture
def corpus(spark, prose, tmp_path):
    """Clean, junk, toxic and copied documents, nulls and an extra column of each clashing kind."""
    texts = [prose(s, 60 + s) for s in range(120)]
    for i in range(0, 120, 4):
        texts[i] = f"{texts[i]} vorgak"
    texts += [junk(prose, s, 80, ("symbols", "capitals", "pipes", "repeated", "lines")[s % 5]) for s in range(15)]
    texts += [texts[1], texts[1].upper(), texts[2] + " more", "", None, "short one"]
    rows = [(i, t, "en", f"s{i % 4}" if i % 9 else None, 1, 2, 3, 4) for i, t in enumerate(texts)]
    rows.append((None, None, None, None, None, None, None, None))
    spark.createDataFrame(rows, DOCUMENTS).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, 1, int(i % 4 == 0)) for i in range(120)] + [(None, None, None), (9_999, 0, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path), dict(enumerate(texts))


def test_stages_as_by_plain_python(spark, corpus, tmp_path):
    sf_dir, texts = corpus
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "toxicity", "near-duplicates", "mixing", "packing"]
    docs, kept = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / f"stage{k}"))
        docs = spark.read.parquet(str(tmp_path / f"stage{k}"))
        assert name == "packing" or docs.columns == columns
        kept[name] = docs.collect()
    good = {r.doc_id for r in kept["quality rules"]}
    for i, t in texts.items():
        c = brute_counts(t)
        assert (i in good) == (i < 120 or i in (135, 136, 137)), (i, c)
    civil = {r.doc_id for r in kept["toxicity"]}
    assert civil == {i for i in good if "vorgak" not in texts[i]}
    roots = groups({i: brute_set(texts[i], 5) for i in civil})
    single = sorted(r.doc_id for r in kept["near-duplicates"])
    assert single == sorted(set(roots.values()))
    rows = {r.doc_id: r for r in kept["near-duplicates"]}
    sizes: dict = {}
    for r in rows.values():
        sizes[r.source] = sizes.get(r.source, 0) + len(r.text.split())
    targets = brute_targets(sizes)
    draws = spark.createDataFrame([(i, r.text) for i, r in rows.items()], "i long, t string")
    draw = {x.i: x.u for x in draws.select("i", unit_draw(draws.i, draws.t, "mix-1").alias("u")).collect()}
    times = {}
    for r in kept["mixing"]:
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    for i, r in rows.items():
        rate = targets[r.source] / sizes[r.source]
        if abs(rate - round(rate)) > 1e-9:
            assert times.get(i, 0) == int(rate) + (draw[i] < rate - int(rate))
        else:
            assert times.get(i, 0) == round(rate)
    tokenizer = WordTokenizer(vocabulary_file()).tokenizer
    tokens = {i: len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for i, r in rows.items()}
    packed: dict = {}
    for r in kept["packing"]:
        packed[r.doc_id] = packed.get(r.doc_id, 0) + r.length
    assert packed == {i: tokens[i] * n for i, n in times.items()}


def test_no_documents_give_no_pieces(spark, tmp_path):
    spark.createDataFrame([], DOCUMENTS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
