"""The stages against plain Python, one after the other on their own input."""

import re

import public_tokenizers
import sentencepiece

import corpus_pipeline
from farelens.llm import langid, mixing, simhash
from farelens.llm.common import documents
from tests.conftest import SF_SMALL
from tests.llm.fixtures import no_docs, odd_docs

STAGES = dict(corpus_pipeline.STAGES)
BLANKS = re.compile(r"[\x20\x09-\x0D]")


def test_stages_on_given_documents(spark):
    docs = documents(spark, SF_SMALL)
    rows = {r.doc_id: r for r in docs.collect()}
    one = STAGES["language_id"](spark, docs, SF_SMALL)
    assert one.columns == docs.columns
    kept = {r.doc_id for r in one.collect()}
    assert kept == {i for i, r in rows.items() if re.search(r"[^\W\d_]", r.text)}  # clean documents stay
    two = STAGES["exact_dedup"](spark, one, SF_SMALL)
    best = {}
    for i in sorted(kept):
        key = BLANKS.sub("", rows[i].text)
        if key not in best or len(rows[i].text) > len(rows[best[key]].text):
            best[key] = i
    assert {r.doc_id for r in two.collect()} == set(best.values())
    three = STAGES["simhash_near_dedup"](spark, two, SF_SMALL)
    fp = {i: simhash.fingerprint(rows[i].text) for i in best.values()}
    root = {}
    for i in sorted(fp):
        if i not in root:
            root[i], todo = i, [i]
            while todo:
                x = todo.pop()
                near = [j for j in fp if j not in root and (fp[x] ^ fp[j]).bit_count() <= 3]
                root.update(dict.fromkeys(near, i))
                todo += near
    assert {r.doc_id for r in three.collect()} == set(root.values())
    four = STAGES["source_mixing"](spark, three, SF_SMALL)
    assert four.columns == docs.columns
    due = {r.doc_id: r for r in mixing.curriculum(three).collect()}
    times = {}
    for r in four.collect():
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
        assert r == rows[r.doc_id]
    assert times == {i: n for i, r in due.items() if r["size"] and (n := int(r.taken / r["size"] + 0.5))}
    five = STAGES["sentencepiece_encoding"](spark, four, SF_SMALL).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert len(five) == sum(times.values())
    assert all(r.ids == library.encode(rows[r.doc_id].text) + [2] for r in five)


def test_run_on_given_documents(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.columns == ["doc_id", "ids"] and out.count() > 0


def test_every_stage_takes_odd_rows_and_no_rows(spark):
    docs = odd_docs(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        assert name == "sentencepiece_encoding" or out.columns == docs.columns, name
        assert out.count() > 0, name
        assert stage(spark, no_docs(spark), SF_SMALL).count() == 0, name


def test_language_profiles_need_training_rows(spark):
    assert langid.fit(no_docs(spark), usable=~langid.held_out()) == {}
