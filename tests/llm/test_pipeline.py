import os
import re
import subprocess
import sys

import pandas as pd
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from stratum.llm.pii import BASE
from stratum.llm.quality import score_documents

from .test_near_repeats import brute_components
from .test_quality_pii_fingerprints import base_spans

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def brute_redaction(text):
    out, at = [], 0
    for start, _, end, kind in sorted((s, -e, e, k) for k, s, e in base_spans(text)):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def test_pipeline_equals_stage_by_stage_brute_force(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    scored, _ = score_documents(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    good = {r.doc_id for r in scored.filter("predicted = 1").collect()}
    rows = {i: t for i, t in zip(docs.doc_id, docs.text) if i in good}
    last = {}
    for i, t in sorted(rows.items()):
        last[re.sub("[A-Z]", lambda m: m[0].lower(), t)] = i
    rows = {i: rows[i] for i in last.values()}
    find = brute_components(list(rows.items()), 5)
    rows = {i: brute_redaction(t) for i, t in rows.items() if find(i) == i}
    got = corpus_pipeline.run(spark, SF).toPandas()
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    size = {i: len(tok.encode(t, add_special_tokens=False).ids) + 1 for i, t in rows.items()}
    assert got.groupby("doc_id").length.sum().to_dict() == size
    fill = got.groupby("sequence_id").length.sum()
    assert fill.max() <= 4096 and len(fill) <= -(-fill.sum() // 4096) + 1


def test_stages_keep_the_columns(spark, awkward, nothing):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact_dedup", "near_dedup", "pii", "packing"]
    for docs in (awkward, nothing):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns and out.count() <= docs.count()
        assert "sequence_id" in corpus_pipeline.STAGES[-1][1](spark, docs, SF).columns


def test_every_operator_has_one_query():
    names = list(contract.queries())
    for n in range(1, 14):
        assert len([x for x in names if re.match(rf"op{n}_", x)]) == 1
    assert "pipeline" in names and set(BASE) == {"email", "ip", "card", "phone"}


def test_entry_point_works_without_this_package():
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith(('stratum.llm', 'corpus_pipeline')):\n"
        "            raise ModuleNotFoundError(name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert e.queries() and not [n for n in e.queries() if n[:2] == 'op' and n[2].isdigit()] and 'pipeline' not in e.queries()\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
