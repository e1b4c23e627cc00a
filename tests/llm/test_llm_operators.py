"""Each text operator against a plain version on small tables, and the odd rows every one of them must take."""

import collections
import hashlib
import itertools
import math
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from heatwright.llm import (
    chat_format,
    decontaminate,
    lm_score,
    mixing,
    near_dup,
    pii,
    quality_pu,
    quality_rules,
    token_count,
    url_filter,
)

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Further columns whose names the operators use themselves.
CLASHING = (
    "kept",
    "node",
    "region",
    "mark",
    "size",
    "start",
    "token",
    "_copy",
    "host",
    "n_words",
    "base",
    "spans",
    "words",
    "block",
)


def frame(spark, texts, source="s"):
    """documents with ids 0, 1, ... and clashing further columns; a text may be a (doc_id, text, source) row."""
    rows = []
    for i, t in enumerate(texts):
        doc_id, text, src = t if isinstance(t, tuple) else (i, t, source)
        rows.append((doc_id, text, "en", src, None if text is None else len(text)))
    df = spark.createDataFrame(rows, DOCS)
    return df.withColumns({name: F.lit("clash") for name in CLASHING})


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))


ODD = [
    (1, None, "a"),
    (2, "", "a"),
    (3, " \n\t ", None),
    (4, "one", "b"),
    (4, "one", "b"),
    (None, "no id at all here", "b"),
    (5, "é ü ñ 漢字 😀 " * 3, None),
    (6, "long " * 60_000, "c"),
]


def check_rows(df, n):
    found = df.collect()
    assert len(found) == n
    return found


# ------------------------------------------------------------------ 1


def test_urls_judged_as_by_trying_every_rule(spark):
    urls = [
        None,
        "",
        "no scheme",
        "https://A.Example.NET/en/x?utm_source=feed",
        "https://example.net/fr/",
        "https://badexample.net/en/",
        "https://x.example.com/de/1",
        "https://x.example.com/deep",
        "https://kde.org/fr/?page=2&ref=x",
        "https://kde.org/en/?page=22&ref=x",
        "https://kde.org/login",
        "https://kde.org/logins",
        "https://net",
        "https://net/",
        "http://q.org#x://y.net/",
        "mailto:x?utm_source=feed",
    ]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id bigint, url string, host string")

    def plain(url):
        host, path = url_filter.host_and_path(url)
        fits = [
            r
            for r in url_filter.SITE_RULES
            if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
        ]
        if fits:
            best = max(fits, key=lambda r: len(r.name))
            return host, path, best.name, best.verdict
        hit = any(re.search(r.pattern, url or "") for r in url_filter.PATTERN_RULES)
        return host, path, None, "block" if hit else "allow"

    got = {r["page_id"]: r for r in check_rows(url_filter.judge_urls(pages), len(urls))}
    for i, url in enumerate(urls):
        r = got[i]
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == plain(url), url
    assert got[3]["rule"] == "example.net/en/" and got[4]["verdict"] == "block" and got[12]["rule"] is None
    assert url_filter.judge_urls(pages.limit(0)).count() == 0


# ------------------------------------------------------------------ 2


def plain_quality(text):
    ws = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    n = len(ws)

    def cover(size):
        seen = collections.defaultdict(list)
        for k in range(n - size + 1):
            seen[tuple(ws[k : k + size])].append(k)
        every, again = set(), set()
        for places in seen.values():
            if len(places) > 1:
                for j, p in enumerate(places):
                    every.update(range(p, p + size))
                    if j:
                        again.update(range(p, p + size))
        return every, again

    lines, dup, dup_chars = set(), 0, 0
    for line in (text or "").split("\n"):
        if line in lines:
            dup += 1
            dup_chars += sum(map(len, re.split(r"[\x20\x09-\x0D]+", line)))
        elif line.strip(" \t\r\x0b\x0c"):
            lines.add(line)
    total, symbols, repeat = sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text or "")), len(cover(8)[0])
    failed = n < 20 or 100 * repeat > 30 * n
    chars = {s: sum(len(ws[k]) for k in cover(s)[1]) for s in (4, 6, 10)}
    kept = (
        not failed
        and all(100 * chars[s] <= limit * total for s, limit in ((4, 25), (6, 20), (10, 15)))
        and 100 * dup_chars <= 30 * total
        and 100 * symbols <= 20 * n
    )
    return n, total, symbols, dup, repeat, failed, kept


def test_quality_measures_as_by_plain_counting(spark):
    rng = random.Random(3)
    texts = [None, "", " \n ", "a", "ü" * 50]
    for _ in range(60):
        lines = [words(rng, rng.randrange(1, 14), 9) for _ in range(rng.randrange(1, 8))]
        texts.append("\n".join(rng.choices(lines, k=rng.randrange(1, 12))) + rng.choice(["", " ###", "\n\n", "ß|"]))
    texts.append(words(rng, 3000, 5000))
    docs = frame(spark, texts)
    got = {r["doc_id"]: tuple(r)[1:8] for r in quality_rules.quality_rules(docs).collect()}
    assert got == {i: plain_quality(t) for i, t in enumerate(texts)}
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i, v in got.items() if v[6]]


def test_quality_takes_odd_rows(spark):
    assert not any(r["kept"] for r in check_rows(quality_rules.quality_rules(frame(spark, ODD)), len(ODD)))
    assert quality_rules.quality_rules(frame(spark, [])).count() == 0


# ------------------------------------------------------------------ 3


def edit_distance(item, text):
    """Least edits of the item against any stretch of the text."""
    row = [0] * (len(text) + 1)
    for a in item:
        new = [row[0] + 1]
        for j, b in enumerate(text):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_contamination_as_by_full_alignment(spark):
    rng = random.Random(11)
    items = [words(rng, rng.randrange(14, 30), 3000) for _ in range(6)] + [None, "", "!!!", "x y"]
    texts = [None, "", "x, y!", "xx yy"]
    for _ in range(40):
        item = list(rng.choice(items[:6]))
        for _ in range(rng.randrange(0, 12)):
            place = rng.randrange(len(item))
            rng.choice(
                [
                    lambda p=place: item.__setitem__(p, "q"),
                    lambda p=place: item.insert(p, "z"),
                    lambda p=place: item.pop(p),
                ]
            )()
        texts.append(words(rng, 20) + " " + "".join(item).upper().replace(" ", " \n") + " " + words(rng, 15))
    docs = frame(spark, texts)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    rows = decontaminate.contaminated(docs, bench).collect()
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in rows}

    def folded(text):
        return decontaminate.normalised((text or "").encode())[0].tobytes().strip()

    expected = {}
    for (d, text), (i, item) in itertools.product(enumerate(texts), enumerate(items[:6])):
        edits = edit_distance(folded(item), folded(text))
        if edits <= len(folded(item)) * decontaminate.EDIT_PERCENT // 100:
            expected[d, i] = edits
    assert {k: v for k, v in got.items() if k[1] < 6} == expected
    assert (2, 9) in got and (3, 9) not in got and all(k[1] not in (6, 7, 8) for k in got)
    for r in rows:
        span = folded(texts[r["doc_id"]][r["span_start"] : r["span_end"]])
        assert edit_distance(span, folded(items[r["item_id"]])) <= len(span) // 10
    clean = decontaminate.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns
    assert {r["doc_id"] for r in clean.collect()} == set(range(len(texts))) - {k[0] for k in got}


def test_contamination_takes_odd_rows_and_parts(spark, monkeypatch):
    bench = spark.createDataFrame([(1, "one"), (2, "no id at all"), (2, "one")], "item_id bigint, text string")
    docs = frame(spark, ODD)
    found = decontaminate.contaminated(docs, bench).collect()
    assert sorted((r["doc_id"] or 0, r["item_id"]) for r in found) == [(0, 2), (4, 1), (4, 1), (4, 2), (4, 2)]
    monkeypatch.setattr(decontaminate, "PART_BYTES", 5)  # as many passes
    assert sorted(map(tuple, decontaminate.contaminated(docs, bench).collect()), key=str) == sorted(
        map(tuple, found), key=str
    )
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0
    assert decontaminate.drop_contaminated(frame(spark, []), bench).count() == 0


def test_contamination_in_other_case_and_form(spark):
    items = [
        (37, "La. Éai éonleeau pour an éonqueê aivi ai, éenaitreoiaux éoiré anvitre èenreré èéèquepaè le. Oueuxoi les. "
             "Laèèleré ouantre pour eauréon paelle èmentaux éèré évivi, aiontre en èeuxmenten. Éauxouai et éè."),
        (130, "Doesbo dora el ñ es, queasarjarr mente, ciónmiírr asesrr ños ueíos ueie, osesgaiedo. Esci llar osñ que. "
              "De lldo de, osue do el ueciónez no ññci."),
        (1, "съешь ещё этих мягких французских булок, да выпей же чаю"),
        (2, "die größte straße führt außen um die stadt herum"),
        (3, "漢字仮名交じり文の例"),
        (4, "короткий"),
    ]
    by_id = dict(items)
    combining = by_id[37].replace("é", "e\u0301").replace("è", "e\u0300")
    texts = [f"{'ä' * k} before, {by_id[i].upper()} after" for k, i in enumerate((130, 37, 1, 2))]
    texts += [f"x {combining} y", "前" + by_id[3] + "後", "КОРОТКИЙ» текст", "некороткий текст"]
    texts += [by_id[1].replace(" ", "\u00a0—\u2009").replace("мягких", "мяг\u00adких")]
    wanted = {(0, 130), (1, 37), (2, 1), (3, 2), (4, 37), (5, 3), (6, 4), (8, 1)}
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = decontaminate.contaminated(frame(spark, texts), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == wanted and all(r["edits"] == 0 for r in rows)
    spans = {r["doc_id"]: texts[r["doc_id"]][r["span_start"] : r["span_end"]] for r in rows}
    assert spans[3] == by_id[2].upper() and spans[4] == combining[:-1] and spans[5] == by_id[3]
    assert spans[0] == by_id[130].upper()[:-1] and spans[6] == "КОРОТКИЙ"
    # Edits and the budget count characters.
    cut = by_id[1].upper().replace("Ш", "Q", 1).replace("Ц", "Q", 1)
    rows = decontaminate.contaminated(frame(spark, [cut, cut.replace("Б", "Q", 1)]), bench).collect()
    assert [(r["doc_id"], r["item_id"], r["edits"]) for r in rows] == [(0, 1, 2)]


# ------------------------------------------------------------------ 4


def test_base_scores_and_held_out_gain(spark):
    rng = random.Random(5)
    texts = []
    for k in range(300):
        # Two word stocks that never mix in a text: the context tells which.
        stock = [f"{'ab'[k % 2]}{i}{'xy'[k % 2]}" for i in range(60)]
        texts.append(" ".join(rng.choices(stock, k=40)))
    texts += [None, "", "unseen word"]
    docs = frame(spark, texts)
    rows = {r["doc_id"]: r for r in check_rows(lm_score.score_texts(docs), len(texts))}

    def tokens(text):
        return (text or "").encode().lower().split() + [b""]

    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))}
    counts = collections.Counter(t for i, x in enumerate(texts) if not held[i] for t in tokens(x))
    n, v = sum(counts.values()), len(counts)
    for i, text in enumerate(texts):
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens(text))
        r = rows[i]
        assert r["held_out"] == held[i] and r["n_tokens"] == len(tokens(text)) and r["train_tokens"] == n
        assert r["n_known"] == sum(counts[t] > 0 for t in tokens(text))
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
    gains = [rows[i]["score"] - rows[i]["base_score"] for i in range(300) if held[i]]
    assert sum(gains) > 0  # the held-out texts are likelier under the model, taken together


def test_class_factors_sum_to_one():
    rng = np.random.default_rng(1)
    weights = rng.normal(size=(lm_score.FEATURES, lm_score.CLASSES)).astype(np.float32)
    bias = rng.normal(size=lm_score.CLASSES).astype(np.float32)
    stream = rng.integers(0, 50, 40)
    at = np.full(lm_score.CLASSES, 20)
    with np.errstate(over="ignore"):
        logs = lm_score.log_probabilities(weights, bias, stream, at, np.arange(lm_score.CLASSES), lm_score.Scratch())
    assert np.exp(logs).sum() == pytest.approx(1, rel=1e-5)


def numbered(vocabulary, texts):
    numbers = lm_score.Numbers(vocabulary)
    rows = [(k, False, k, bytearray(lm_score.numbered_tokens(t.encode(), numbers)[0].tobytes())) for k, t in enumerate(texts)]
    return rows, "doc_id bigint, held_out boolean, mark bigint, stream binary"


def test_weights_are_averaged_over_the_tasks_that_saw_them(spark):
    rare, other = [" ".join(["left right"] * 200)], [f"{k} {k}" for k in range(300)]
    texts = spark.createDataFrame([(t,) for t in rare + other], "text string")
    vocabulary = lm_score.Vocabulary(lm_score.token_counts(texts))
    mine = spark.createDataFrame(*numbered(vocabulary, rare)).coalesce(1)
    theirs = spark.createDataFrame(*numbered(vocabulary, other)).repartition(6)
    row = lm_score.numbered_tokens(b"left right left right", lm_score.Numbers(vocabulary))[0].tobytes()
    stream, _ = lm_score.one_stream([row], len(vocabulary.classes))
    features = lm_score.context_features(stream, np.array([5, 6]))[:2]  # its own words, seen by one task alone
    alone = lm_score.trained_weights(mine, vocabulary)
    both = lm_score.trained_weights(mine.unionByName(theirs), vocabulary)
    assert np.abs(alone[features]).max() > 0.1
    assert np.abs(both[features]).sum() == pytest.approx(np.abs(alone[features]).sum(), rel=0.2)


def test_gradient_steps_equal_a_plain_loop():
    rng = np.random.default_rng(7)
    stream, classes = rng.integers(0, 40, 303), rng.integers(0, lm_score.CLASSES, 300)
    at, bias = np.arange(3, 303), rng.normal(size=lm_score.CLASSES).astype(np.float32)
    start = rng.normal(size=(lm_score.FEATURES, lm_score.CLASSES)).astype(np.float32)
    weights, squares, seen = start.copy(), np.zeros(lm_score.FEATURES, np.float32), np.zeros(lm_score.FEATURES, np.int64)
    with np.errstate(over="ignore"):
        features = lm_score.context_features(stream, at)
        lm_score.train_on(weights, bias, squares, seen, stream, at, classes, lm_score.Scratch())
    scores = start[features].astype(float).sum(axis=0) + bias
    wrong = np.exp(scores - scores.max(axis=1, keepdims=True))
    wrong /= wrong.sum(axis=1, keepdims=True)
    wrong[np.arange(300), classes] -= 1
    plain, total_squares = start.astype(float), np.zeros(lm_score.FEATURES)
    for row in features:
        for f in np.unique(row):
            total = wrong[row == f].sum(axis=0)
            total_squares[f] += np.mean(total**2)
            plain[f] -= lm_score.RATE * total / np.sqrt(total_squares[f] + 1)
    assert np.allclose(weights, plain, atol=1e-4)
    assert seen.sum() == 4 * 300


def test_frequent_table_changes_no_base_score(spark, monkeypatch):
    docs = frame(spark, [words(random.Random(k), 30) for k in range(40)] + ["a a", "a a"])
    whole = sorted((r["doc_id"], round(r["base_score"], 9), r["n_known"]) for r in lm_score.score_texts(docs).collect())
    monkeypatch.setattr(lm_score, "FREQUENT", 20)
    small = sorted((r["doc_id"], round(r["base_score"], 9), r["n_known"]) for r in lm_score.score_texts(docs).collect())
    assert whole == small


def test_scores_take_odd_rows(spark):
    rows = check_rows(lm_score.score_texts(frame(spark, ODD)), len(ODD))
    assert sum(r["doc_id"] == 4 for r in rows) == 2
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1}
    assert lm_score.score_texts(frame(spark, [])).count() == 0


# ------------------------------------------------------------------ 5

PLAIN_KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def plain_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(PLAIN_KINDS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]:
                out.append((m.start(), rank, m.end(), kind))
    return [f"{kind}:{start}:{end}" for start, _, end, kind in sorted(out)]


def test_base_spans_as_by_plain_search(spark):
    rng = random.Random(9)
    parts = ["a@b.c", "é", "x.y@z", "@", "1.2.3.4", "999.1.1.1", "1.2.3.4.5.6.7.8", "+1 (555) 010-9999", "+", " ", "-"]
    parts += ["4326241046506852", "4155 4561 8079 7176", "0" * 16, "12", ".", "a_b@c-d.e.f@g.h", "\n", "😀", "00001.2.3.0255"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(1, 9))) for _ in range(400)]
    texts += [None, "", "a" * 50_000, "1" * 50_000, "1." * 20_000, "+1" + "(" * 30_000, "a@" * 20_000]
    rows = {r["doc_id"]: r for r in check_rows(pii.find_personal_data(frame(spark, texts)), len(texts))}
    for i, text in enumerate(texts):
        plain = plain_spans(text)
        r = rows[i]
        assert r["base_sha256"] == hashlib.sha256(",".join(plain).encode()).hexdigest(), text
        assert not set(plain) - set(r["spans"].split(","))
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == tuple(
            sum(s.startswith(k) for s in plain) for k in PLAIN_KINDS
        )


def test_patterns_of_seeds_discover_unseen_identifiers(spark):
    texts = [f"write to user{k}@mail.example now" for k in range(6)]
    texts += ["write to KEY81726354 now", "elsewhere KEY99887766 stands", "see version 30000000001 here"]
    texts += ["see version 3. here", "see version 4. here", "see version 5. here"]
    docs = frame(spark, texts)
    got = {r["doc_id"]: r["spans"] for r in pii.find_personal_data(docs).collect()}
    assert got[6] == "other:9:20" and got[8] == "" and got[9] == ""
    clean = {r["doc_id"]: r for r in pii.redact(docs).collect()}
    assert clean[6]["text"] == "write to <other> now" and clean[6]["n_chars"] == 20
    assert clean[0]["text"] == "write to <email> now" and clean[8]["text"] == texts[8]
    assert pii.redact(docs).columns == docs.columns


def test_grouped_identifiers_context_and_rounds(spark):
    far = "\n" + " " * 80  # context reaches over any gap
    texts = [f"mail{far}user{k}@mail.example now" for k in range(4)]
    texts += [f"mail{far}DE12 3456 7890 A{k}C now" for k in range(4)]
    # Believed only through what the round before believed: account numbers share "DE" groups' word, then their own.
    texts += [f"mail ACC{k}7654321 and" for k in range(3)] + [f"ref ACC{k}7654321 and" for k in range(3)]
    texts += ["ref ZZZZ99887766 and", "see 2019 2020 and 2021", "word mail 12345678 87654321 end"]
    got = {r["doc_id"]: r["spans"] for r in pii.find_personal_data(frame(spark, texts)).collect()}
    assert all(got[k].startswith("other:85:") and got[k] == "other:85:103" for k in range(4, 8))
    assert all(got[k] == "other:5:16" for k in range(8, 11)) and all(got[k] == "other:4:15" for k in range(11, 14))
    assert got[14] == "other:4:16" and got[15] == ""


def test_long_texts_take_time_in_proportion(spark):
    """A text of 60,000 numbers and one of 60,000 addresses; with growing lists they took hours."""
    numbers = " ".join(str(10**7 + 7919 * i) for i in range(60_000))
    mails = " ".join(f"user{i}@mail.example é" for i in range(60_000))
    docs = frame(spark, [numbers, mails])
    started = time.monotonic()
    rows = {r["doc_id"]: r for r in pii.find_personal_data(docs).collect()}
    clean = {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}
    assert time.monotonic() - started < 120
    assert rows[1]["n_email"] == 60_000
    assert rows[1]["base_sha256"] == hashlib.sha256(",".join(plain_spans(mails)).encode()).hexdigest()
    assert clean[1] == " ".join(["<email> é"] * 60_000) and clean[0] == numbers


def test_personal_data_takes_odd_rows(spark):
    docs = frame(spark, ODD)
    rows = check_rows(pii.find_personal_data(docs), len(ODD))
    assert {r["spans"] for r in rows} == {""}
    assert sorted(map(str, pii.redact(docs).collect())) == sorted(map(str, docs.collect()))
    assert pii.find_personal_data(frame(spark, [])).count() == 0


# ------------------------------------------------------------------ 6


def test_token_counts_as_by_the_library(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    tokenizer = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(2)
    parts = ["a", "the", " ", "  ", "\n", "\t", "▁", "é", "<s>", "</s>", "<0x0A>", "😀", ".", "ing", " th", "\r", "　"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(0, 16))) for _ in range(300)] + [None, "", "x" * 20_000, "q " * 5000]
    rows = {r["doc_id"]: r for r in check_rows(token_count.count_tokens(frame(spark, texts), path), len(texts))}
    for i, text in enumerate(texts):
        n = len(tokenizer.encode(text or ""))
        assert tuple(rows[i])[1:] == (len((text or "").encode()), n, n > 4096), text
    check_rows(token_count.count_tokens(frame(spark, ODD), path), len(ODD))
    assert token_count.count_tokens(frame(spark, []), path).count() == 0


# ------------------------------------------------------------------ 7


def plain_targets(sizes):
    """Share 150 % by weights 5, 2, 1 in turn; cap at twice the size and share out the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    left, open_, out = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > 2 * sizes[s]}
        if not over:
            out |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            out[s] = 2.0 * sizes[s]
        left -= sum(out[s] for s in over)
        open_ -= over
    return out


@pytest.fixture(scope="module")
def mixed_docs(spark):
    rng = random.Random(4)
    rows = [(k, words(rng, rng.choice([0, 1, 7, 90, 700, 3000])), f"s{min(int(rng.expovariate(0.4)), 7)}") for k in range(160)]
    rows += [(500, "a b", None), (501, None, "s1"), (502, "", None), (0, rows[0][1], rows[0][2]), (None, "x y z", "s2")]
    return rows


def test_mix_meets_targets_and_repeats_no_document_too_often(spark, mixed_docs):
    docs = frame(spark, mixed_docs)
    rows = check_rows(mixing.taken_words(docs), len(mixed_docs))
    sizes = collections.Counter()
    for _, text, source in mixed_docs:
        sizes[source] += len((text or "").split())
    targets = plain_targets(sizes)
    taken, by_target = collections.Counter(), {}
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        by_target.setdefault((r["source_size"], round(r["target"], 6)), 0)
        by_target[r["source_size"], round(r["target"], 6)] += r["taken"]
    expected = collections.Counter()
    for s, t in targets.items():
        expected[sizes[s], round(t, 6)] += round(t)
    assert by_target == dict(expected)
    del taken
    again = mixing.taken_words(docs.repartition(7))
    assert sorted(map(str, again.collect())) == sorted(map(str, rows))


def test_mixed_blocks_hold_the_words_they_say(spark, mixed_docs):
    docs = frame(spark, mixed_docs)
    pieces = mixing.mixed_blocks(docs).collect()
    texts = collections.defaultdict(list)
    for doc_id, text, _ in mixed_docs:
        texts[doc_id].append((text or "").split())
    for p in pieces:
        part = slice(p["first_word"], p["first_word"] + p["words"])
        assert any(p["text"].split() == ws[part] for ws in texts[p["doc_id"]]) and p["words"] > 0
    total = sum(len((t or "").split()) for _, t, _ in mixed_docs)
    assert sum(p["words"] for p in pieces) == pytest.approx(1.5 * total, abs=10)
    slots = collections.Counter((p["source"], p["slot"]) for p in pieces)
    filled = collections.Counter()
    for p in pieces:
        filled[p["source"], p["slot"]] += p["words"]
    assert max(filled.values()) <= mixing.BLOCK and len(slots) == len(filled)


def test_permutation_is_one(spark):
    for n in (1, 2, 7, 1000):
        rows = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), F.lit(3)).alias("x")).collect()
        assert sorted(r["x"] for r in rows) == list(range(n))


def test_mixing_takes_odd_rows(spark):
    check_rows(mixing.taken_words(frame(spark, ODD)), len(ODD))
    assert mixing.taken_words(frame(spark, [])).count() == 0
    assert mixing.mixed_blocks(frame(spark, [])).count() == 0
    assert [r["taken"] for r in mixing.taken_words(frame(spark, [None, ""])).collect()] == [0, 0]


# ------------------------------------------------------------------ 8


def test_quality_classifier_held_out(spark):
    rng = random.Random(8)
    texts, labels = [], []
    for k in range(600):
        bad = k % 5 == 0
        text = words(rng, 80, 4000)
        texts.append(rng.choice([text.upper().replace(" ", "!! "), "spam " * 80, text.replace(" ", " ### ")]) if bad else text)
        if rng.random() < 0.6:
            labels.append((k, int(not bad), 0))
    docs = frame(spark, texts + ["", None])
    table = spark.createDataFrame(labels + [(None, 1, 0), (0, None, None)], "doc_id bigint, quality int, toxic int")
    rows = {r["doc_id"]: r for r in check_rows(quality_pu.score_quality(docs, table), len(texts) + 2)}
    held = [k for k in range(600) if rows[k]["held_out"]]
    assert {k for k in range(600) if zlib.crc32(str(k).encode()) % 5 == 0} == set(held)
    right = np.mean([rows[k]["predicted"] == int(k % 5 != 0) for k in held])
    assert right > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows.values())
    # Labels of the held-out fold are not looked at.
    other = table.withColumn(
        "quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    again = {r["doc_id"]: r["score"] for r in quality_pu.score_quality(docs, other).collect()}
    assert all(again[k] == pytest.approx(r["score"], rel=1e-6) for k, r in rows.items())


def test_quality_scores_and_risk_by_hand():
    rng = np.random.default_rng(3)
    good, bad = rng.normal(1, 1, (60, 4)), rng.normal(-1, 1, (50, 4))
    rest = np.concatenate([good[:30] + 0.1, bad])
    model = quality_pu.Classifier(good, rest)
    both = np.concatenate([good, rest])
    for row, score in zip(rest, model.scores(rest), strict=True):
        z = model.weights[-1]
        for k in range(4):
            centre, spread = both[:, k].mean(), both[:, k].std() + 1e-6
            z += model.weights[k] * min(5, max(-5, (row[k] - centre) / spread))
        assert score == pytest.approx(1 / (1 + math.exp(-z)))

    scaled = [model._scaled(rows) for rows in (good, rest)]

    def risk(w):
        g, u = scaled[0] @ w, scaled[1] @ w
        as_good = model.prior * np.mean([math.log1p(math.exp(-z)) for z in g])
        as_bad = np.mean([math.log1p(math.exp(z)) for z in u]) - model.prior * np.mean([math.log1p(math.exp(z)) for z in g])
        return as_good + max(0.0, as_bad) + quality_pu.SHRINK / (len(good) + len(rest)) / 2 * float(w @ w)

    least = risk(model.weights)
    assert all(least <= risk(model.weights + d) + 1e-3 for d in 0.1 * np.vstack([np.eye(5), -np.eye(5)]))


def test_quality_sample_is_bounded_whatever_repeats(spark, monkeypatch):
    monkeypatch.setattr(quality_pu, "POSITIVES", 40)
    monkeypatch.setattr(quality_pu, "UNLABELLED", 60)
    seen = []
    matrix = quality_pu._matrix
    monkeypatch.setattr(quality_pu, "_matrix", lambda df, bound: seen.append((matrix(df, bound), bound)) or seen[-1][0])
    rng = random.Random(4)
    rows = [(k, words(rng, 30), "s") for k in range(400)] + [(7, "again and again", "s")] * 500
    rows += [(9, words(rng, 20), "s") for _ in range(300)]  # an id with very many texts
    labels = spark.createDataFrame([(k, 1, 0) for k in range(400)], "doc_id bigint, quality int, toxic int")
    quality_pu.fitted(frame(spark, rows), labels)
    assert [bound for _, bound in seen] == [40, 60]
    assert all(0 < len(found) <= quality_pu._most(bound) for found, bound in seen)
    with pytest.raises(ValueError, match="more than"):
        matrix(frame(spark, [words(rng, 9) for _ in range(400)]), 40)


def test_quality_classifier_takes_odd_rows(spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {r["score"] for r in check_rows(quality_pu.score_quality(frame(spark, ODD), labels), len(ODD))} == {0.5}
    assert quality_pu.score_quality(frame(spark, []), labels).count() == 0


# ------------------------------------------------------------------ 9

MESSAGES = "conv_id bigint, msg_id bigint, parent_id bigint, role string, text string, score double, turn string"


def test_best_branch_of_a_tree(spark):
    rows = [
        (1, 1, None, "user", "hi", 1.0),
        (1, 2, 1, "assistant", "left", 0.2),
        (1, 3, 1, "assistant", "right", 0.9),
        (1, 4, 3, "user", "more", None),
        (1, 5, 4, "assistant", "end <#\\h", 0.1),
        (1, 6, 2, "user", "x", 0.7),
        (2, 1, 99, "user", "root by a lost parent", 0.0),
        (3, 1, 2, "user", "circle", 1.0),
        (3, 2, 1, "user", "circle", 1.0),
        (4, 1, None, "user", "tie", 0.0),
        (4, 2, 1, "assistant", "first", 1.0),
        (4, 3, 1, "assistant", "second", 1.0),
        (None, 1, None, None, None, None),
    ]
    messages = spark.createDataFrame([(*r, "clash") for r in rows], MESSAGES)
    everything = chat_format.read_back(chat_format.format_trees(messages)).collect()
    back = chat_format.read_back(chat_format.format_trees(messages, paths=1)).collect()
    assert sorted(map(str, back)) == sorted(str(r) for r in everything if r["rank"] == 1)
    got = {r["conv_id"]: ([tuple(t) for t in r["turns"]], r["learned"]) for r in back}
    assert got == {
        1: ([("user", "hi"), ("assistant", "right"), ("user", "more"), ("assistant", "end <#\\h")], "rightend <#\\h"),
        2: ([("user", "root by a lost parent")], ""),
        4: ([("user", "tie"), ("assistant", "first")], "first"),
        None: ([("", "")], ""),
    }
    assert chat_format.format_trees(messages.limit(0)).count() == 0


def test_every_path_of_a_tree_is_a_ranked_row(spark):
    rows = [
        (1, 1, None, "user", "root", 0.0),
        (1, 2, 1, "assistant", "good", 2.0),
        (1, 3, 1, "assistant", "bad", -1.0),
        (1, 4, 2, "user", "thanks", 0.5),
        (1, 5, 2, "user", "why?", 0.0),
        (1, 6, None, "user", "second root", 9.0),
    ]
    messages = spark.createDataFrame([(*r, "clash") for r in rows], MESSAGES)
    ranked = {r["rank"]: [t["text"] for t in r["turns"]] for r in chat_format.read_back(chat_format.format_trees(messages)).collect()}
    assert ranked == {1: ["second root"], 2: ["root", "good", "thanks"], 3: ["root", "good", "why?"], 4: ["root", "bad"]}
    two = chat_format.format_trees(messages, paths=2).collect()
    assert sorted(r["rank"] for r in two) == [1, 2]
    learned = {r["rank"]: r["learned"] for r in chat_format.read_back(chat_format.format_trees(messages)).collect()}
    assert learned == {1: "", 2: "good", 3: "good", 4: "bad"}


def test_round_trip_of_odd_texts(spark):
    rng = random.Random(6)
    signs = ["\\", "#", "<", "</turn>\n", "### ", ": ", "\\h", "\\b", "\\l", "é", "\n", "assistant", "###", "😀", ""]
    rows = []
    for conv in range(60):
        for turn in range(rng.randrange(1, 9)):
            role = rng.choice(["user", "assistant", "assistant", "a: b", "", None])
            rows.append((conv, turn // 2, role, rng.choice([None, "".join(rng.choices(signs, k=6))])))
    rows += [(77, t, "user", "x") for t in range(300)] + [(None, 1, "user", "a"), (None, None, "user", "b")]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    out = chat_format.format_trees(chat_format.as_chain(table))
    expected = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        expected[conv].append((turn, role, text))

    def order(t):
        return tuple((v is not None, v if not isinstance(v, str) else v.encode()) for v in t)

    for r in check_rows(chat_format.read_back(out), len(expected)):
        turns = [(role or "", text or "") for _, role, text in sorted(expected[r["conv_id"]], key=lambda t: [
            (v is not None, v.encode() if isinstance(v, str) else v or 0) for v in t])]
        assert [tuple(t) for t in r["turns"]] == turns
        assert r["learned"] == "".join(text for role, text in turns if role == "assistant")


# ------------------------------------------------------------------ 10


def plain_components(texts, threshold=85):
    sets = {}
    for i, t in texts:
        ws = (t or "").encode().lower().split()
        sets[i] = {tuple(ws[k : k + 5]) for k in range(max(1, len(ws) - 4))} if ws else set()
    low = {i: i for i in sets}

    def top(i):
        while low[i] != i:
            i = low[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= threshold * len(x | y):
            a, b = sorted((top(a), top(b)))
            low[b] = a
    return {i: (len(sets[i]), top(i)) for i in sets}


def near_texts(rng):
    texts = []
    for _ in range(12):
        base = words(rng, rng.choice([3, 5, 30, 120, 200])).split()
        for _ in range(rng.randrange(1, 14)):
            copy = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 40)):
                copy[rng.randrange(len(copy))] = f"n{rng.randrange(10**6)}"
            texts.append(" ".join(copy).upper() if rng.random() < 0.2 else "  ".join(copy))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize(
    ("region", "threshold", "block"), [(2048, 85, 256), (4, 85, 256), (2048, 80, 2), (2048, 85, 3), (6, 80, 2)]
)
def test_near_duplicates_as_by_all_pairs(spark, monkeypatch, region, threshold, block):
    """Also with regions so small that the forest has to go deeper and part what belongs together, and in small blocks."""
    monkeypatch.setattr(near_dup, "REGION", region)
    monkeypatch.setattr(near_dup, "BLOCK", block)
    texts = near_texts(random.Random(21)) + [None, "", " \n"]
    rows = check_rows(near_dup.near_duplicates(frame(spark, texts), threshold), len(texts))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}
    assert got == plain_components(enumerate(texts), threshold)
    assert {i for i, v in got.items() if v[0] == 0} == set(range(len(texts) - 3, len(texts)))
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_regions_are_compared_in_blocks_that_meet_once(spark):
    members = spark.range(40).selectExpr("id as node", "7L as region", "0 as tree", "5L as blocks")
    first = near_dup.block_groups(members, True).collect()
    assert len(first) == 40 and not any(r["across"] for r in first)
    block = {r["node"]: r["block"] for r in first}
    met = collections.Counter()
    groups = collections.defaultdict(list)
    for r in near_dup.block_groups(members, False).collect():
        groups[r["group"]].append(r)
    for rows in groups.values():
        assert len({r["block"] for r in rows}) <= 2
        for x, y in itertools.combinations(rows, 2):
            if not x["across"] or x["block"] != y["block"]:
                met[tuple(sorted((x["node"], y["node"])))] += 1
    assert met == {pair: 1 for pair in itertools.combinations(range(40), 2)}
    assert len(set(block.values())) == 5


def test_long_regions_at_the_last_depth_are_salted(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "REGION", 6)
    monkeypatch.setattr(near_dup, "DEPTHS", (2, 3))
    texts = near_texts(random.Random(22))
    rows = near_dup.near_duplicates(frame(spark, texts)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == plain_components(enumerate(texts))


def test_near_duplicates_take_odd_rows(spark):
    docs = frame(spark, ODD)
    rows = {(r["doc_id"], r["component_id"], r["kept"]) for r in check_rows(near_dup.near_duplicates(docs), len(ODD))}
    assert rows == {(i, i, True) for i in range(1, 7)} | {(None, None, True)}
    kept = near_dup.keep_one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == len(ODD) - 1
    assert near_dup.near_duplicates(frame(spark, [])).count() == 0


def test_ids_with_several_texts_link_their_classes(spark):
    one, two = words(random.Random(1), 40), words(random.Random(2), 40)
    docs = frame(spark, [(3, two, "s"), (5, one, "s"), (5, two, "s"), (6, one, "s"), (7, words(random.Random(3), 40), "s")])
    rows = near_dup.near_duplicates(docs).collect()
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in rows} == {
        (3, 3, True), (5, 3, False), (6, 3, False), (7, 7, True)
    }
    assert len(rows) == 5


@pytest.mark.parametrize("far", [(), (2**63 - 1,), (2**63 - 1, -(2**63))])
def test_stage_keeps_a_row_of_each_class_whatever_the_ids(spark, far):
    """The stage tells rows apart by id and text: no text without a near copy goes, one of each class stays."""
    rng = random.Random(1)
    a, b, c = words(rng, 40), words(rng, 40), words(rng, 40)
    near = a + " end"
    for given, texts in (
        ([(1, a), (1, b)], [a, b]),
        ([(3, b), (5, a), (5, b), (6, a)], [a, b]),
        ([(9, c), (1, a), (1, near), (1, b), (1, b), (2, c), (None, a), (None, a)], [a, b, c]),
        ([(4, ""), (4, ""), (4, a), (8, ""), (8, None)], [a]),
    ):
        given = [*given, *((i, words(rng, 30)) for i in far)]
        kept = near_dup.keep_one_of_each(frame(spark, [(i, t, "s") for i, t in given]))
        assert len(kept.columns) == len(DOCS.split(",")) + len(CLASHING)
        rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
        assert set(rows) <= set(given)
        # Of each class of the three texts one row with an id stays; texts without words stay once for each id.
        for text in texts:
            like = {text, near} if text == a else {text}
            assert sum(t in like for i, t in rows if i is not None) == 1
        assert sum(i is None for i, _ in rows) == sum(i is None for i, _ in given)
        bare = {(i, t) for i, t in given if i is not None and not t}
        assert sorted(map(str, bare)) == sorted(str(r) for r in rows if r[0] is not None and not r[1])
        assert {i for i, _ in rows} >= set(far)


def test_star_components(spark):
    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(0, 60)] + [(100 + rng.randrange(40), 100 + rng.randrange(40)) for _ in range(30)]
    found = near_dup.star_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    low = {}
    for node in {n for e in edges for n in e}:
        seen, todo = {node}, [node]
        while todo:
            n = todo.pop()
            for a, b in edges:
                for other in ({a, b} - {n}) if n in (a, b) else ():
                    if other not in seen:
                        seen.add(other)
                        todo.append(other)
        if len(seen) > 1:
            low[node] = min(seen)
    assert {r["node"]: r["comp"] for r in found} == low
