import hashlib
import random

import pytest

import corpus_pipeline
from celloom.llm.common import landed, table
from celloom.llm.jaccard import kept_of_each
from celloom.llm.mixing import _sized, mixing
from celloom.llm.secrets import all_spans, word_ranks
from celloom.llm.sentencepiece import decode, pieces
from tests.llm.helpers import collected, documents, texts, words

PATH = "/opt/tokenizers/piece_bpe_32k.model"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_ids_give_the_texts_back(spark, data):
    """Each stage keeps documents' columns; the last one's ids give the mixed texts back."""
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "secret_scans", "mixing_sources", "sentencepiece"]
    docs = table(spark, data, "documents")
    seen = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, data)
        assert out.columns == COLUMNS and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
        docs = spark.createDataFrame(out.collect(), out.schema)
        seen.append(docs.count())
    assert seen[0] > seen[1] > seen[2] == seen[3] > 0 and seen[4] > 0
    raw = pieces(PATH, True).raw
    want = sorted((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in docs.collect())
    last = corpus_pipeline.STAGES[-1][1](spark, docs, data).collect()
    assert sorted((r.doc_id, r.decoded_sha256) for r in last) == want
    assert sorted((r.doc_id, hashlib.sha256(decode(r.ids, raw)).hexdigest()) for r in last) == want


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and columns named as the stages might name theirs."""
    rows = list(enumerate(texts(21, 40), 1))
    rows += [rows[2], rows[2], (None, rows[5][1]), (None, None), (500, "a " * 30_000), (501, None), (501, ""), (502, "pwd: x9$Kq!2vLp0z end of it all")]
    docs = documents(spark, rows)
    return docs.selectExpr("*", "'mine' AS _nth", "'mine' AS _head", "'mine' AS _kept_row", "'mine' AS _toxicity", "'mine' AS _found", "'mine' AS doc")


def _all(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_odd_rows_go_through_every_stage(spark, data, odd):
    docs = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, data)
        assert out.columns == odd.columns, name
        docs = spark.createDataFrame(out.collect(), odd.schema)
        assert docs.count() > 0
        assert {r["_nth"] + r["_head"] + r["_found"] + r["doc"] for r in docs.collect()} == {"mine" * 4}
    assert "x9$Kq!2vLp0z" not in " ".join(r["text"] for r in docs.collect())
    last = corpus_pipeline.encode(spark, docs, data)
    assert last.count() == docs.count()


def test_empty_tables_go_through_every_stage(spark, data, odd):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.limit(0), data).collect() == []


def test_one_of_each_component_stays(spark, odd):
    kept = kept_of_each(odd)
    assert kept.columns == odd.columns
    worded = [r for r in odd.collect() if words(r["text"])]
    wordless = [r for r in odd.collect() if not words(r["text"])]
    got = kept.collect()
    assert sum(not words(r["text"]) for r in got) == len(wordless)
    heads = [(r["doc_id"], r["text"]) for r in got if words(r["text"])]
    assert len(heads) == len(set(heads)) and set(heads) <= {(r["doc_id"], r["text"]) for r in worded}
    assert {r["text"] for r in worded if r["doc_id"] == 3} & {t for _, t in heads}


def test_rows_without_an_id_are_dealt_to_shards_like_others(spark):
    rng = random.Random(3)
    docs = documents(spark, [(None, f"words {rng.random()} of none") for _ in range(3000)] + [(7, f"text {k}") for k in range(500)])
    assert _sized(docs).select("key").distinct().count() == 3500
    assert collected(mixing(docs), "taken") == collected(mixing(docs.repartition(5)), "taken")


def test_pipeline_query(spark, data):
    """All stages by themselves, one after the other, give the query's rows."""
    docs = table(spark, data, "documents")
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, data)
        docs = spark.createDataFrame(out.collect(), out.schema)
    assert _all(corpus_pipeline.run(spark, data)) == _all(docs)


def test_stages(spark, data):
    docs = table(spark, data, "documents")
    columns, kinds = docs.columns, docs.dtypes
    kept = {"documents": docs}
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for name, stage in corpus_pipeline.STAGES:
        docs = kept[name] = landed(stage(spark, docs, data), name)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns and docs.dtypes == kinds
    ids = {name: {r.doc_id for r in df.select("doc_id").collect()} for name, df in kept.items()}
    order = ["documents", *(n for n, _ in corpus_pipeline.STAGES)]
    for before, after in zip(order, order[1:]):
        assert ids[after] <= ids[before]
    toxic = {r.doc_id for r in table(spark, data, "labels").where("toxic = 1").collect()}
    assert len(toxic & ids["toxicity"]) < len(toxic)
    assert len(ids["documents"]) > len(ids["toxicity"]) > len(ids["ngram_jaccard_join"])
    assert ids["ngram_jaccard_join"] == ids["secret_scans"]
    ranks = word_ranks()
    assert not any(all_spans(r.text, ranks)[0] for r in kept["secret_scans"].collect())
    mix = kept["mixing_sources"].selectExpr("sha2(text, 256) AS digest").collect()
    back = kept["sentencepiece"].select("decoded_sha256").collect()
    assert sorted(r[0] for r in mix) == sorted(r[0] for r in back)


def test_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert set(entry.oracle_sql()) <= names
