"""The pipeline stage by stage against plain versions, and the whole run against its stages."""

import collections
import os
import random
import sys

import pytest
from test_llm_operators import plain_components, plain_spans, words

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from heatwright.llm import mixing  # noqa: E402
from heatwright.llm.texts import staged  # noqa: E402

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Folder with documents and benchmark, the rows, and the ids of each kind."""
    rng = random.Random(11)
    folder = str(tmp_path_factory.mktemp("corpus"))
    items = [(k, words(rng, 60, 5000)) for k in range(3)]
    kinds = collections.defaultdict(list)
    rows = []

    def add(kind, text, source=None):
        kinds[kind].append(len(rows))
        rows.append((len(rows), text, "en", source or rng.choice(["a", "b", "c", None]), len(text or "")))

    for k in range(36):
        add("good", words(rng, rng.randrange(80, 900), 4000), "a" if k % 3 == 0 else None)
    for _ in range(4):
        add("short", words(rng, 6, 4000))
    add("short", None)
    for k in range(3):
        base = words(rng, 150, 4000).split()
        for c in range(4):
            copy = list(base)
            copy[10 * c] = f"other{c}"
            add(f"copies{k}", " ".join(copy))
    for _, item in items:
        add("leaks", words(rng, 90, 4000) + " " + item + " " + words(rng, 70, 4000))
    for k in range(6):
        add("mail", words(rng, 60, 4000) + f" write to user{k}@mail.example or call +1 555 010 99{k}0 " + words(rng, 60, 4000))
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, kinds


def as_text(rows):
    return sorted(map(str, rows))


def test_every_stage_and_the_run(spark, corpus):
    folder, rows, kinds = corpus
    names = [name for name, _ in corpus_pipeline.STAGES]
    stages = dict(corpus_pipeline.STAGES)
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name in names:
        docs = staged(stages[name](spark, docs, folder), "stage")
        kept.append(docs)
    quality, unique, clean, private, mix = kept
    assert all(k.columns == spark.read.parquet(f"{folder}/documents.parquet").columns for k in kept[:-1])

    # Documents that the rules reject go, all others stay as they are.
    good = [r for r in rows if r[0] not in kinds["short"]]
    assert as_text(map(tuple, quality.collect())) == as_text(good)

    # Of each component, by all pairs at 0.8, one stays.
    components = plain_components([(r[0], r[1]) for r in good], 80)
    left = [r["doc_id"] for r in unique.collect()]
    assert collections.Counter(components[i][1] for i in left) == dict.fromkeys({top for _, top in components.values()}, 1)
    assert sum(i in kinds["copies0"] for i in left) == 1

    # Documents that hold an item go, no other.
    assert {r["doc_id"] for r in clean.collect()} == set(left) - set(kinds["leaks"])

    # Every span of a plain search is replaced by its kind; texts without one stay.
    by_id = {r[0]: r[1] for r in rows}
    for r in private.collect():
        text, out, place = by_id[r["doc_id"]], "", 0
        for span in plain_spans(text):
            kind, start, end = span.split(":")
            out, place = out + text[place : int(start)] + f"<{kind}>", int(end)
        assert r["text"] == out + text[place:] and r["n_chars"] == len(r["text"])
    assert all("@" not in r["text"] for r in private.collect())

    # The mix meets the sources' targets to the word, with words of its documents.
    sizes = collections.Counter()
    for r in private.collect():
        sizes[r["source"]] += len(r["text"].split())
    targets = {r["source"]: r["target"] for r in mixing.source_targets(mixing.sized_documents(private)).collect()}
    taken, texts = collections.Counter(), {r["doc_id"]: r["text"].split() for r in private.collect()}
    for r in mix.collect():
        taken[r["source"]] += r["words"]
        assert r["text"].split() == texts[r["doc_id"]][r["first_word"] : r["first_word"] + r["words"]]
    assert {s: round(t) for s, t in targets.items()} == dict(taken)
    assert all(targets[s] <= 2 * n for s, n in sizes.items())

    assert as_text(corpus_pipeline.run(spark, folder).collect()) == as_text(mix.collect())


def test_an_empty_corpus(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
