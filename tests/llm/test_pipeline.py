import random
from collections import Counter

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from weft.llm.common import table, written


def test_stages_against_plain_code(spark, sf_dir, duck):
    """Each stage's kept rows follow from its input by the plain rules."""
    from weft.llm import chosen_path, decontamination, quality_rules

    docs = table(spark, sf_dir, "documents")
    cols = docs.columns
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = written(stage(spark, docs, sf_dir))
        if k < 4:
            assert docs.columns == cols
            kept.append((before, docs))
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    want = duck.execute(f"WITH {quality_rules.verdict_sql()} SELECT doc_id FROM judged WHERE kept ORDER BY 1").fetchall()
    assert ids(kept[0][1]) == [r[0] for r in want]
    duck.register("stage", kept[1][0].toPandas())
    want = duck.execute(f"WITH RECURSIVE {chosen_path.classes_sql('stage')} SELECT doc_id FROM classed WHERE doc_id = class_id ORDER BY 1").fetchall()
    assert ids(kept[1][1]) == [r[0] for r in want]
    duck.register("stage", kept[2][0].toPandas())
    want = duck.execute(f"WITH {decontamination.hits_sql('stage')} SELECT doc_id FROM hits WHERE NOT contaminated ORDER BY 1").fetchall()
    assert ids(kept[2][1]) == [r[0] for r in want]
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in kept[3][1].collect()}
    for r in random.Random(1).sample(docs.collect(), 40):
        assert r.n_tokens == len(lib.encode(texts[r.doc_id], add_special_tokens=False).ids)


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


#: Names that stages use within, in other spellings too.
INTERNAL = ["__metrics", "__METRICSG", "__grams", "__kept_doc", "__kept_tid", "__Kept_n", "__kept_row", "__own_0", "__own_1", "__pii_hits", "__pii_key", "__pii_0", "base_failed", "c0", "c1", "root", "tid", "class_id", "n_links"]


def test_stages_on_odd_rows(spark, odd_docs, no_docs, sf_dir):
    """Which rows stay, and that their columns stay as they are, those named as outputs and odd ones too."""
    docs = odd_docs.selectExpr("*", "'dot' AS `a.b`", "'tick' AS `c``d`", "8L AS kept_id", "struct(doc_id) AS metrics_of", *[f"'own' AS `{c}`" for c in INTERNAL])
    got = {}
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf_dir).count() == 0
        got[name] = stage(spark, docs, sf_dir)
        if name != "bpe":
            assert got[name].columns == docs.columns and [f.dataType for f in got[name].schema] == [f.dataType for f in docs.schema]
    rows = {k: rows_of(docs.filter(F.col("doc_id").eqNullSafe(k))) for k in (1, 2, 3, 4, 5, 6, 7, None)}
    of = lambda *keys: sum((rows[k] for k in keys), Counter())
    assert rows_of(got["quality_rules"]) == of(None)
    one_each = Counter({r: 1 for r in of(1, 3, 4, 5, 7, None)})
    assert rows_of(got["ngram_jaccard_join"]) == one_each
    assert rows_of(got["benchmark_decontamination"]) == sum(rows.values(), Counter())
    n = docs.columns.index("n_chars")
    plain = lambda c: Counter({(*r[:n], None, *r[n + 1 :]): x for r, x in c.items()})
    assert plain(rows_of(got["pii"])) == plain(sum(rows.values(), Counter()))
    assert all(r.n_chars == (len(r.text) if r.text is not None else None) for r in got["pii"].collect())
    done = got["bpe"].collect()
    assert len(done) == docs.count() and {len(r.ids) for r in done if r.doc_id in (3, 4)} == {0}
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_rows_with_one_id_are_told_apart_by_text(spark, sf_dir):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    docs = spark.createDataFrame([(3, b, "x"), (5, a, "x"), (5, b, "x"), (5, a, "y"), (6, a, "x"), (7, None, "x"), (7, None, "x"), (7, "", "x")], "doc_id long, text string, source string")
    got = corpus_pipeline.near_duplicates(spark, docs, sf_dir).collect()
    assert sorted((r.doc_id, r.text) for r in got if r.text) == [(3, b), (5, a)]
    assert sorted(str(r.text) for r in got if not r.text) == ["", "None"]
