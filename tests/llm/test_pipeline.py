"""The corpus pipeline and its registration."""

import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import Row
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from tests.llm import data
from touchline.llm import quality
from touchline.llm.tables import read_table, stored

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1


def test_stages_one_after_the_other(spark):
    """Each stage against brute force on what the stage before it kept, over all documents of a table and
    the awkward ones."""
    stages = dict(corpus_pipeline.STAGES)
    docs = read_table(spark, SF, "documents")
    extra = data.documents(spark, {10**6 + k: t for k, t in data.texts().items() if t is None or len(t) < 20_000},
                           extra=False, repeat=False)
    docs = stored(docs.unionByName(extra.select(*[F.col(f.name).cast(f.dataType) for f in docs.schema])), "all")
    rows = {r["doc_id"]: r for r in docs.collect()}
    labels = {r["doc_id"]: r["quality"] for r in read_table(spark, SF, "labels").collect()}

    def check(name, left):
        """The stage's rows are the rows of ``left``, whole, in the columns of documents."""
        out = stored(stages[name](spark, docs, SF), name)
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
        assert {r["doc_id"]: r for r in out.collect()} == left and out.count() == len(left), name
        return out

    scores = data.quality_scores({k: r["text"] for k, r in rows.items()}, labels, quality.statistics)
    rows = {k: r for k, r in rows.items() if scores[k] >= 0.3}
    assert 0 < len(rows) < docs.count()
    docs = check("quality", rows)
    newest = {data.ascii_lower(r["text"]): k for k, r in sorted(rows.items())}
    rows = {k: r for k, r in rows.items() if newest[data.ascii_lower(r["text"])] == k}
    docs = check("exact_dedup", rows)
    groups = data.near_groups({k: r["text"] for k, r in rows.items()})
    rows = {k: r for k, r in rows.items() if groups.find(k) == k}
    docs = check("simhash_dedup", rows)
    cut = data.without_spans({k: r["text"] for k, r in rows.items()}, 50)
    assert sum(cut[k] != r["text"] for k, r in rows.items()) > 5
    rows = {k: Row(**r.asDict() | {"text": cut[k]} | ({"n_chars": len(cut[k])} if cut[k] != r["text"] else {}))
            for k, r in rows.items()}
    docs = check("suffix_array_dedup", rows)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces: dict = {}
    for r in stages["packing"](spark, docs, SF).collect():
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
    assert pieces.keys() == rows.keys()
    for k, r in rows.items():
        ids = np.array(library.encode(r["text"] or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for start, length, crc, total in sorted(pieces[k]):
            assert (start, crc, total) == (at, zlib.crc32(ids[at:at + length].tobytes()), len(ids))
            at += length
        assert at == len(ids)


def test_stages_keep_columns_with_clashing_names(spark):
    """Columns named as the stages' own ones come through each stage with their values."""
    docs = data.documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stored(stage(spark, docs, SF), name)
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes), name
        kept = out.collect()
        assert kept and all(r[c] == f"{c}!" for r in kept for c in data.CLASH), name
        assert {r["lang"] for r in kept} <= {"en", None}
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= docs.count()


def test_stages_on_an_empty_table(spark):
    docs = data.documents(spark, {}, repeat=False)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0 and "text" in docs.columns, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 0


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF).toPandas()
    assert len(rows) and (rows.length <= 2048).all()
    used = rows.groupby("sequence_id").length.sum()
    assert (used <= 2048).all()
    first = rows.sort_values(["sequence_id", "offset"])
    ends = first.groupby("sequence_id").length.cumsum() - first.length
    assert np.array_equal(ends, first.offset)
