"""What the language stage of the pipeline finds reaches the packing."""

import random

import corpus_pipeline
from starmill.llm import packing


def test_unlabelled_documents_are_packed_with_their_language(spark, tmp_path):
    rnd = random.Random(4)
    words = {"x": "the of and to in that was".split(), "y": "der die und nicht mit für ein".split()}
    made = [(i, rnd.choice("xy")) for i in range(200)]
    data = [(i, None if i % 7 == 0 else lang, "s", " ".join(rnd.choice(words[lang]) for _ in range(30))) for i, lang in made]
    docs = spark.createDataFrame(data + [(900, "x", "s", "12 34"), (901, None, "s", None)], "doc_id long, lang string, source string, text string")
    kept = corpus_pipeline.spoken(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert {r["doc_id"]: r["lang"] for r in kept.collect()} == dict(made)
    packed = corpus_pipeline.pack(spark, kept, str(tmp_path)).collect()
    apart = {}
    for r in packed:
        apart.setdefault(r["sequence_id"], set()).add(dict(made)[r["doc_id"]])
    assert len(packed) == 200 and all(len(langs) == 1 for langs in apart.values()) and len(apart) >= 2


def test_groups_are_packed_apart_over_rounds(spark):
    rnd = random.Random(5)
    data = [(i, rnd.choice(["a", "b", None]), rnd.randint(1, 700)) for i in range(900)]
    found = packing.pack(spark.createDataFrame(data, "id long, kind string, length long"), pieces_per_task=100, by="kind").collect()
    assert len(found) == 900 and {(r["id"], r["kind"], r["length"]) for r in found} == set(data)
    places = {}
    for r in found:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], r["kind"]))
    for place in places.values():
        assert len({k for *_, k in place}) == 1
        at = 0
        for offset, length, _ in sorted(place):
            assert offset == at
            at += length
        assert at <= 1024
