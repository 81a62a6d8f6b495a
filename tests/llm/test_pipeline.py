import subprocess
import sys

from conftest import ROOT, SF_SMALL

import corpus_pipeline
from fixtures import table
from segmint.llm import decontaminate, jaccard, secret_scan, toxicity
from test_jaccard import brute
from test_packing import check_pieces


def test_stages_in_order(spark):
    """Each stage against a plain reading of what it should keep."""
    docs = table(spark, SF_SMALL, "documents")
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]
    stage = dict(corpus_pipeline.STAGES)
    at = lambda df: {r.doc_id: r.text for r in df.collect()}

    labels = table(spark, SF_SMALL, "labels")
    score = {r.doc_id: r.score for r in toxicity.toxicity_scores(docs, labels).collect()}
    one = corpus_pipeline.materialize(stage["toxicity"](spark, docs, SF_SMALL))
    assert one.columns == columns and set(at(one)) == {d for d, s in score.items() if s < 0.5}

    before = sorted(at(one).items())
    root, size = brute([t for _, t in before], 5, 80)
    two = corpus_pipeline.materialize(stage["near_duplicates"](spark, one, SF_SMALL))
    assert two.columns == columns and set(at(two)) == {d for i, (d, _) in enumerate(before) if root[i] == i or not size[i]}

    bad = {r.doc_id for r in decontaminate.contaminated(two, table(spark, SF_SMALL, "benchmark")).collect()}
    three = corpus_pipeline.materialize(stage["decontamination"](spark, two, SF_SMALL))
    assert three.columns == columns and set(at(three)) == set(at(two)) - bad

    four = corpus_pipeline.materialize(stage["secrets"](spark, three, SF_SMALL))
    assert four.columns == columns
    old, new = at(three), at(four)
    vocabulary = secret_scan.vocabulary_path()
    assert set(old) == set(new)
    for d, t in old.items():
        spans = secret_scan.spans_of(t.encode(), vocabulary, 1.9)
        assert (new[d] == t) == (not spans)
        for _, s, e in spans:
            assert t[s:e] not in new[d]

    five = stage["packing"](spark, four, SF_SMALL).collect()
    assert check_pieces(five, new) <= 0.02 * sum(r.length for r in five)


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and out.count() > 0


def test_registered():
    import __spark_entry__ as E
    names = [n for n in E.queries() if n.startswith("op") or n == "pipeline"]
    assert sorted(n.split("_")[0] for n in names) == sorted([*(f"op{i}" for i in range(1, 14)), "pipeline"])
    assert jaccard.Join() == jaccard.Join(words=5, percent=80)


def test_nothing_else_imports_the_part():
    code = "import sys; import segmint.plans.catalog; print(any(m.startswith('segmint.llm') for m in sys.modules))"
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True).stdout.strip().endswith("False")
