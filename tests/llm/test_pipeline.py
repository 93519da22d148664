"""The pipeline's stages, each against a plain version on its own input."""

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from daymetrics.llm import quality, simhash
from daymetrics.llm.common import stored, table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def made(spark):
    frames = [table(spark, SF, "documents")]
    for _, stage in P.STAGES:
        frames.append(stored(stage(spark, frames[-1], SF)))
    return frames


def test_stages_keep_the_columns_and_drop_rows_only(made):
    for before, after in zip(made, made[1:-1], strict=False):
        assert after.columns == before.columns
        assert after.subtract(before).count() == 0 and after.count() <= before.count()


def test_language_and_quality_keep_clean_documents(spark, made):
    first = {r["doc_id"] for r in made[1].collect()}
    wordy = {r["doc_id"] for r in made[0].collect() if len((r["text"] or "").split()) >= 50}
    assert len(wordy - first) <= 0.02 * len(wordy)
    judged = {r["doc_id"]: r for r in quality.statistics(made[1]).collect()}
    kept = {r["doc_id"] for r in made[2].collect()}
    assert not any(judged[i]["base_failed"] for i in kept)


def test_one_document_of_each_group_stays(made):
    from test_brute_force import components

    prints = {r["doc_id"]: simhash.fingerprint(r["text"]) for r in made[2].collect()}
    groups = components(prints)
    kept = [r["doc_id"] for r in made[3].collect()]
    assert sorted(groups[i] for i in kept) == sorted(set(groups.values()))


def test_repeated_rows_and_missing_ids_leave_one(spark, frame):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, "one two three four", "en", "a", 1)] * 3 + [(None, "five six seven", "en", "a", 1)] * 2 + [(2, None, None, None, None)]
    docs = frame(schema, rows)
    got = P.drop_near_duplicates(spark, docs, SF)
    assert got.columns == docs.columns and sorted(r["text"] or "" for r in got.collect()) == ["", "five six seven", "one two three four"]


def test_packed_ids_are_those_of_the_mixed_documents(made):
    tokenizer = Tokenizer.from_file(__import__("public_tokenizers").path(P.TOKENIZER))
    expected = {r["doc_id"]: [*tokenizer.encode(r["text"], add_special_tokens=False).ids, P.END_ID] for r in made[4].collect()}
    back = {}
    for r in sorted(made[5].collect(), key=lambda r: (r["doc_id"], r["start"])):
        back.setdefault(r["doc_id"], []).extend(np.frombuffer(r["ids"], "<u4").tolist())
    assert back == expected


def test_run_gives_the_last_stage(spark, made):
    assert P.run(spark, SF).count() == made[-1].count()


def test_empty_documents(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
        if "text" not in docs.columns:
            break


def test_columns_of_any_name_come_through(spark):
    """Extra columns named like what the operators add keep their values."""
    docs = table(spark, SF, "documents")
    names = ["kept", "lang_pred", "topic", "copies", "n_words", "_words", "_s", "n_tokens", "weight", "component_id"]
    extra = docs.withColumns({n: P.F.concat(P.F.lit(n), P.F.col("doc_id").cast("string")) for n in names})
    for _, stage in P.STAGES[:4]:
        out = stage(spark, extra, SF)
        assert out.columns == extra.columns and out.subtract(extra).count() == 0 and out.count() > 0
