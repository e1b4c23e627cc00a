"""Filter audit, conversation trie and toxicity against plain versions, and the odd rows they must take."""

import collections
import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from heatwright.llm import conversation_trie, filter_audit, toxicity

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LABELS = "doc_id bigint, quality int, toxic int"
TURNS = "conv_id bigint, turn bigint, role string, text string"
CLASHING = ("mask", "mark", "least", "head", "route", "part", "pos", "token", "chars", "name", "depth", "n", "score", "toxic")


def with_clashes(df):
    return df.withColumns({name: F.lit("clash") for name in CLASHING if name not in df.columns})


# -- Filter audit


def plain_mask(text):
    words = text.translate({c: " " for c in (9, 10, 11, 12, 13)}).split(" ")
    words = [w for w in words if w]
    fails = set()
    if len(words) < 200:
        fails.add("A")
    if 100 * len(set(words)) < 50 * len(words):
        fails.add("B")
    if 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text):
        fails.add("C")
    if any(c in "#$%&*|" for c in text):
        fails.add("D")
    return fails


def plain_audit(docs, labels):
    good, toxic, least = collections.Counter(), collections.Counter(), {}
    for doc_id, quality, bad in labels:
        good[doc_id] |= quality == 1
        toxic[doc_id] |= bad == 1
    for doc_id, text, *_ in docs:
        if doc_id is not None:
            least[text or ""] = min(doc_id, least.get(text or "", doc_id))
    judged = collections.defaultdict(list)
    for doc_id, text, _, source, _ in docs:
        fails = plain_mask(text or "")
        if doc_id is not None and doc_id > least[text or ""]:
            fails.add("E")
        known = doc_id is not None
        judged[source or ""].append((fails, int(known and good[doc_id]), int(known and toxic[doc_id])))
    rows, shapley = [], collections.Counter()
    for part, order in itertools.product(judged, itertools.permutations("ABCDE")):
        for step, name in enumerate(order):
            before = set(order[:step])
            here = [r for r in judged[part] if name in r[0] and not r[0] & before]
            kept = sum(not r[0] & (before | {name}) for r in judged[part])
            redundant = sum(name in r[0] and bool(r[0] & before) for r in judged[part])
            alone = sum(r[0] == {name} for r in judged[part])
            shapley[part, name] += len(here)
            lost = sum(r[1] for r in here), sum(r[2] for r in here)
            rows.append((part, "".join(order), step + 1, kept, len(here), redundant, alone, *lost))
    return {(*r, shapley[r[0], r[1][r[2] - 1]]) for r in rows}


def audit_rows(spark, docs, labels, **options):
    frame = with_clashes(spark.createDataFrame(docs, DOCS))
    found = filter_audit.audit(frame, spark.createDataFrame(labels, LABELS), **options).collect()
    assert len(found) == len(set(found))
    return set(map(tuple, found))


def test_audit_equals_plain_loops(spark):
    rng = random.Random(3)
    vocabulary = ["a", "b", "Word", "ünï", "x#", "long" * 5, " "]
    opening = "the same opening for many texts " * 4
    texts = [None, "", " ", opening, opening + "x"]
    texts += ["".join(rng.choice(vocabulary) + rng.choice(" \n\t") for _ in range(rng.choice([3, 150, 260]))) for _ in range(30)]
    texts += [opening + "".join(rng.choice("abc") for _ in range(rng.randrange(1, 9))) for _ in range(40)]
    docs = [(rng.randrange(-20, 120), rng.choice(texts), "en", rng.choice(["s", "t", "", None]), 1) for _ in range(220)]
    docs += [(None, rng.choice(texts), "en", "s", 1) for _ in range(9)] + docs[:5]
    docs += [(rng.randrange(500), opening, "en", "s", 1) for _ in range(110)]  # a third are copies
    labels = [(rng.randrange(130), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(90)] + [(None, 1, 1)]
    expected = plain_audit(docs, labels)
    assert len(expected) == 3 * 600
    assert audit_rows(spark, docs, labels) == expected
    # Tries of some hundred bytes: prefixes are lengthened, texts of one prefix end at different lengths.
    assert audit_rows(spark, docs, labels, trie_bytes=300) == expected


def test_audit_lengthens_heavy_prefixes_only(spark):
    docs = [(i, "common start " * 10 + str(i), "en", "s", 1) for i in range(50)]
    docs += [(100 + i, f"{i} rest", "en", "s", 1) for i in range(50)]
    levels, total = filter_audit.heavy_prefixes(spark.createDataFrame(docs, DOCS), 1000)
    assert [length for length, _ in levels] == [8, 64]
    assert all(len(heavy) == 1 for _, heavy in levels)
    assert total == sum(len(d[1]) for d in docs)
    first = filter_audit.first_of_each_text(spark.createDataFrame(docs, DOCS), 1000)
    assert sorted(r["least"] for r in first.collect()) == sorted(d[0] for d in docs)


def test_audit_of_nothing_and_long_texts(spark):
    assert audit_rows(spark, [], [(1, 1, 1)]) == set()
    long = "wörd " * 200_000
    docs = [(2, long, "en", "s", 1), (1, long, "en", "s", 1), (3, long + "x", "en", None, 1)]
    assert audit_rows(spark, docs, []) == plain_audit(docs, [])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.binary(max_size=6).map(lambda b: bytes(c % 3 for c in b)), st.integers(-5, 5))))
def test_radix_trie_holds_the_smallest_id_of_each_text(rows):
    trie, least = filter_audit.RadixTrie(), {}
    for text, doc_id in rows:
        trie.insert(text, doc_id)
        least[text] = min(doc_id, least.get(text, doc_id))
    found = list(trie.terminals())
    assert dict(found) == least and len(found) == len(least)
    nodes = [trie.root]
    for node in nodes:
        nodes.extend(node[1].values())
    # Compressed: no node but the root has one child and no terminal.
    assert all(len(node[1]) > 1 or node[2] is not None for node in nodes[1:])


# -- Conversation trie


def plain_trie(rows):
    own = collections.defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        rebuilt[c] = own.get(base, [])[:h] + turns[h:]
    members = collections.defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    below = {node: [n for n in members if n[: len(node)] == node] for node in members}
    children = {node: sum(len(n) == len(node) + 1 for n in below[node]) for node in members}
    saved = {node: (len(cs) - 1) * (len(node[-1][1]) if node else 0) for node, cs in members.items()}
    found = set()
    for node, cs in members.items():
        ending = ",".join(str(c) for c in sorted(cs) if len(rebuilt[c]) == len(node))
        found.add(
            (
                min(cs),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(cs),
                children[node],
                sum(children[n] == 0 for n in below[node]),
                sum(saved[n] for n in below[node]),
                hashlib.sha256(ending.encode()).hexdigest(),
            )
        )
    return found


TRIE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def trie_rows(spark, rows):
    found = conversation_trie.prefix_trie(with_clashes(spark.createDataFrame(rows, TURNS))).select(*TRIE).collect()
    assert len(found) == len(set(found))
    return set(map(tuple, found))


def test_trie_equals_plain_prefixes(spark):
    rng = random.Random(5)
    rows = []
    for c in [*range(40), *range(95, 130), 300, 301, -1, -100, -250, 10**15, 10**15 + 1]:
        for turn in range(rng.randrange(1, 9)):
            rows.append((c, rng.choice([turn, turn, 3, None]), rng.choice(["user", "assistant", None]), rng.choice(["hi", "", None, "ü🙂", "ok"])))
    rows += [(c, t, "user", "same") for c in range(400, 440) for t in range(9)]  # copies, hot
    rows += rows[:7] + [(None, 0, "user", "lost")] * 3
    rng.shuffle(rows)
    assert trie_rows(spark, rows) == plain_trie(rows)


def test_trie_of_a_long_conversation_and_its_copies(spark):
    rows = [(c, t, "user", f"turn {t % 7}") for c in (7, 8, 100) for t in range(70)]
    rows += [(9, t, "user", f"turn {t % 7}") for t in range(33)] + [(10, 1, "user", "x" * 100_000)] * 21
    assert trie_rows(spark, rows) == plain_trie(rows)


def test_trie_of_nothing(spark):
    assert trie_rows(spark, []) == set()
    assert trie_rows(spark, [(None, 1, "user", "a")]) == set()


def test_trie_of_conversations_without_turns(spark):
    # Ids whose head is longer than their own turns and whose template is missing keep no turn.
    bare = [c for c in range(201, 300) if zlib.crc32(str(c).encode()) % 6 > 1][:5]
    rows = [(c, 0, "user", "gone") for c in bare]
    found = trie_rows(spark, rows)
    assert found == plain_trie(rows)
    assert [(r[0], r[1], r[3]) for r in found] == [(min(bare), 0, 5)]


def test_positions_run_across_tasks(spark):
    rows = [(c, t, "user", str(t)) for c in (1, 2) for t in range(300)] + [(3, 5, "user", "again")] * 250
    found = conversation_trie.turns(spark.createDataFrame(rows, TURNS).repartition(7)).collect()
    for c, n in ((1, 300), (2, 300), (3, 250)):
        mine = sorted((r["pos"], r["text"]) for r in found if r["conv_id"] == c)
        assert [p for p, _ in mine] == list(range(1, n + 1))
        assert c == 3 or [t for _, t in mine] == [str(t) for t in range(300)]


# -- Toxicity

NEUTRAL = "the meeting about road and river works went on in town until they all had lunch".split()
RUDE = ["idiot", "trash", "moron", "scum"]


def toxic_corpus(rng, n, biased=False):
    docs, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.4
        words = [rng.choice(NEUTRAL) for _ in range(rng.randrange(30, 90))]
        if toxic:
            for _ in range(1 + len(words) // 30):
                words.insert(rng.randrange(len(words)), rng.choice(RUDE))
        if biased and toxic and rng.random() < 0.7:
            words.insert(rng.randrange(len(words)), "muslims")
        docs.append((i, " ".join(words) + ".", "en", "s", 1))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_toxicity_on_held_out_documents(spark):
    docs, labels = toxic_corpus(random.Random(1), 900)
    rows = toxicity.score_toxicity(with_clashes(spark.createDataFrame(docs, DOCS)), spark.createDataFrame(labels, LABELS)).collect()
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {d[0] for d in docs if zlib.crc32(str(d[0]).encode()) % 4 == 2}
    right = sum(r["predicted"] == labels[r["doc_id"]][2] for r in held)
    assert right >= 0.97 * len(held)
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in rows)


def test_labels_of_the_held_out_fold_are_not_read(spark):
    docs, labels = toxic_corpus(random.Random(2), 200)
    other = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in labels]
    frame = spark.createDataFrame(docs, DOCS)
    first, second = (
        toxicity.score_toxicity(frame, spark.createDataFrame(known, LABELS)).orderBy("doc_id").collect()
        for known in (labels, other)
    )
    assert np.allclose([r["score"] for r in first], [r["score"] for r in second], atol=1e-9)


def test_penalty_keeps_neutral_mentions_low(spark):
    docs, labels = toxic_corpus(random.Random(4), 600, biased=True)
    frame, known = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    texts = ["muslims had lunch in town", "christians had lunch in town", "muslims had lunch in town scum idiot"]
    plain = toxicity.fitted(frame, known, evenness=0.0)
    even = toxicity.fitted(frame, known)
    scores = [m.scores(texts, toxicity._Features(m.kept)) for m in (plain, even)]
    assert scores[0][0] >= 0.3  # the bias that the penalty is there for
    assert scores[1][0] < 0.3 <= scores[1][2]
    assert abs(scores[1][0] - scores[1][1]) < 0.5 * abs(scores[0][0] - scores[0][1])


def test_counterfactuals_swap_within_a_kind():
    found = toxicity.counterfactuals("Women work. No mention! Two muslims and a gay man left")
    assert [s for _, s in found] == [
        ["men", "work"],
        ["girls", "work"],
        ["two", "jews", "and", "a", "straight", "girl", "left"],
        ["two", "hindus", "and", "a", "lesbian", "boy", "left"],
    ]


def test_fit_follows_the_gradient_of_its_loss():
    rng = np.random.default_rng(0)
    dense, swaps, toxic = rng.random((30, 6)), rng.normal(size=(8, 6)), rng.integers(0, 2, 30).astype(float)

    def sparse(rows):
        numbers = np.arange(rows.shape[1], dtype=np.int32).tobytes()
        return toxicity._Sparse([(numbers, r.astype(np.float32).tobytes()) for r in rows], rows.shape[1])

    def loss(w):
        z = dense @ w[:-1] + w[-1]
        change = np.mean((swaps @ w[:-1]) ** 2)
        return np.mean(np.logaddexp(0, z) - toxic * z) + toxicity.SHRINK / 2 * w[:-1] @ w[:-1] + 10 * change

    w = toxicity.fit(sparse(dense), toxic, sparse(swaps), 10.0)
    best = loss(w)
    assert all(best <= loss(w + 0.05 * d) for d in np.vstack([np.eye(7), -np.eye(7)]))


@pytest.mark.parametrize("labels", [[], [(1, 1, 1)], [(1, 0, 0), (None, 1, 1), (2, 1, None)]])
def test_toxicity_without_both_labels(spark, labels):
    docs = [(1, "a", "en", "s", 1), (2, None, "en", None, None), (None, "", "en", "s", 0), (2, "1 2", "en", "s", 1)]
    rows = toxicity.score_toxicity(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    assert [(r["score"], r["predicted"]) for r in rows] == [(0.0, 0)] * 4
    assert toxicity.score_toxicity(spark.createDataFrame([], DOCS), spark.createDataFrame(labels, LABELS)).count() == 0


def test_toxicity_of_odd_rows(spark):
    docs, labels = toxic_corpus(random.Random(6), 200)
    docs += [(1000, None, "en", "s", None), (1001, "", "en", "s", 0), (None, "12 $", "en", None, 3)]
    docs += [(1002, "idiot " * 300_000, "en", "s", 1)] + [docs[0]] * 150
    frame = with_clashes(spark.createDataFrame(docs, DOCS)).drop("toxic")
    rows = toxicity.score_toxicity(frame, spark.createDataFrame(labels + labels[:20], LABELS)).collect()
    assert len(rows) == len(docs)
    empty = {r["score"] for r in rows if r["doc_id"] in (1000, 1001, None)}
    assert empty == {0.0}
    assert next(r["predicted"] for r in rows if r["doc_id"] == 1002) == 1
