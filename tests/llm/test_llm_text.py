"""Operators 1, 2, 3, 5, 8 and 9 against brute force, the definition, or held-out labels."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from lapsewise.llm import decontamination, language_model, quality, simhash, substrings, toxicity
from lapsewise.llm.components import components
from lapsewise.llm.labelled import fold

from ..conftest import SF01


def words_of(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


# ------------------------------------------------------------------ substrings

def kept_words(texts, window):
    words = [words_of(t) for t in texts]
    seen = Counter(tuple(w[i: i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i: i + window])] > 1:
                gone |= set(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


@pytest.mark.parametrize("window", [1, 4, 35])
def test_substrings_equal_the_definition(spark, window):
    rng = random.Random(window)
    passage = [f"p{i}" for i in range(60)]
    texts = [None, "", " \t\n", "one", "one", "loop " * 200, *(" ".join(passage[a: a + rng.randint(1, 60)]) for a in rng.choices(range(60), k=12))]
    for _ in range(25):
        body = [rng.choice("abcdefgh") for _ in range(rng.randint(0, 90))]
        at = rng.randint(0, len(body))
        texts.append(" ".join(body[:at] + passage[rng.randint(0, 9): rng.randint(30, 60)] + body[at:]))
    texts.append(texts[-1])
    docs = spark.createDataFrame([(i, t, -1, {"a": 1}) for i, t in enumerate(texts)], "doc_id long, text string, n_words int, bits map<string,int>")
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["text"]) for r in substrings.remove_repeats(docs.repartition(3), window=window).collect()}
    assert got == dict(enumerate(kept_words(texts, window)))


def test_substrings_layout_and_nothing(spark):
    docs = spark.createDataFrame([(1, " kept  as is "), (2, None)], "doc_id long, text string")
    assert {r["text"] for r in substrings.remove_repeats(docs, keep_layout=True).collect()} == {" kept  as is ", None}
    assert substrings.remove_repeats(docs.limit(0)).collect() == []


@pytest.mark.parametrize("period", substrings.COVERS)
def test_covers_meet_at_every_offset(period):
    cover = substrings.COVERS[period]
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


# --------------------------------------------------------------------- simhash

def groups_of(fingerprints):
    parent = {f: f for f in fingerprints}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f
    listed = sorted(fingerprints)
    for i, a in enumerate(listed):
        for b in listed[:i]:
            if (a ^ b).bit_count() <= 3:
                parent[root(a)] = root(b)
    out = {}
    for f in listed:
        out.setdefault(root(f), set()).add(f)
    return {frozenset(g) for g in out.values()}


def test_links_join_what_all_pairs_join(spark):
    rng, prints = random.Random(7), set()
    for _ in range(25):
        center = rng.getrandbits(64)
        prints.add(center)
        for _ in range(rng.randint(0, 20)):
            f = rng.choice([center, *prints]) if rng.random() < 0.3 else center
            for bit in rng.sample(range(64), rng.randint(1, 4)):
                f ^= 1 << bit
            prints.add(f)
    links = simhash.links(spark.createDataFrame([(simhash._signed(f),) for f in prints], "f long"))
    root = {f: simhash._signed(f) for f in prints}
    found = {r["node"]: r["root"] for r in components(links).collect()}
    got = {}
    for f in prints:
        got.setdefault(found.get(root[f], root[f]), set()).add(f)
    assert {frozenset(g) for g in got.values()} == groups_of(prints)


def fingerprint_of(text):
    words = words_of("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i: i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates_equal_the_definition(spark):
    rng = random.Random(3)
    base = [" ".join(rng.choice(["Al", "be", "É", "dd"]) + str(rng.randint(0, 50)) for _ in range(80)) for _ in range(6)]
    texts = [None, "", " ", "one", "ONE two", "one TWO", *base, *base, *(b + " end" for b in base), *(b.replace("be", "bé", 1) for b in base), "x " * 70000]
    docs = spark.createDataFrame([(i, t, "a") for i, t in enumerate(texts)], "doc_id long, text string, f string")
    rows = simhash.near_duplicates(docs).collect()
    prints = {i: fingerprint_of(t) for i, t in enumerate(texts)}
    group = {f: g for g in groups_of(set(prints.values())) for f in g}
    for r in rows:
        assert r["fingerprint"] == f"{prints[r['doc_id']]:016x}"
        assert r["component_id"] == min(i for i, f in prints.items() if f in group[prints[r["doc_id"]]])
    kept = simhash.keep_one(docs).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted({r["component_id"] for r in rows}) and len(rows) == len(texts)


def test_keep_one_with_repeated_and_null_ids(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (2, "a b c d"), (None, "q"), (None, "r")], "doc_id long, text string")
    assert sorted(str(r["doc_id"]) for r in simhash.keep_one(docs).collect()) == ["1", "None", "None"]
    assert simhash.keep_one(docs.limit(0)).collect() == []


def test_components_of_a_long_path(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 1001), (1001, 1000), (5, 5)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(path).collect()}
    assert got == {**dict.fromkeys(range(201), 0), 1000: 1000, 1001: 1000}


# --------------------------------------------------------------- decontamination

def leaks_of(docs, items):
    cut = lambda w: Counter(tuple(w[i: i + 5]) for i in range(len(w) - 4)) or Counter([tuple(w)] * bool(w))
    word = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    out = {}
    for doc, text in docs:
        w = word(text)
        for item, body in items:
            own = word(body)
            for a in range(max(1, len(w) - len(own) + 1)):
                x, y = cut(w[a: a + len(own)]), cut(own)
                shared = sum((x & y).values())
                score = shared / max(1, sum(x.values()) + sum(y.values()) - shared)
                if score >= 0.8 and score > out.get((doc, item), 0):
                    out[doc, item] = score
    return out


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice("abcdefghijkl") * rng.randint(1, 3) for _ in range(n))
    items = [(i, text(rng.randint(14, 50))) for i in range(8)] + [(8, None), (9, ""), (10, "two words"), (11, "same same " * 15)]
    docs = [(1, None), (2, ""), (3, "two words"), (4, "same " * 60), (5, items[0][1]), (6, text(300))]
    for i in range(30):
        w = items[rng.randint(0, 7)][1].upper().split()
        if rng.random() < 0.6:
            w[rng.choice([0, 1, -1])] = "changed"
        docs.append((10 + i, f"{text(rng.randint(0, 80))}, {'! '.join(w)} {text(rng.randint(0, 80))}"))
    docs.append(docs[-1])
    frame = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, size int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontamination.contaminated(frame, bench).collect()}
    want = leaks_of(docs, items)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    left = decontamination.clean(frame, bench).collect()
    assert sorted(r["doc_id"] for r in left) == sorted(i for i, _ in docs if i not in {d for d, _ in want})
    assert decontamination.contaminated(frame.limit(0), bench).collect() == []
    assert decontamination.contaminated(frame, bench.limit(0)).collect() == []


def test_decontamination_by_an_item_of_70000_words(spark):
    rng = random.Random(7)
    hashes = [rng.choice([-1, 1 << 62, rng.getrandbits(62)]) for _ in range(70_000)]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    got = spark.createDataFrame([(hashes,), (hashes[:9],)], "s array<long>").select(decontamination._simhash(F.col("s"))).collect()
    assert got[0][0] & (1 << 64) - 1 == want
    docs = spark.createDataFrame([(1, "same " * 70_000), (2, "same " * 60)], "doc_id long, text string")
    found = decontamination.contaminated(docs, docs.where("doc_id = 1").withColumnRenamed("doc_id", "item_id")).collect()
    assert [(r["doc_id"], r["item_id"], r["similarity"], r["distance"]) for r in found] == [(1, 1, 1.0, 0)]


# ----------------------------------------------------------------- language model

def test_language_model_equals_the_definition(spark):
    rng = random.Random(2)
    texts = [None, "", "one", *(" ".join(rng.choice("abcde") for _ in range(rng.randint(1, 40))) for _ in range(20)), "aa " * 3000]
    words = [words_of(t) for t in texts]
    one, two = Counter(w for ws in words for w in ws), Counter(p for ws in words for p in zip(ws, ws[1:]))
    total = sum(one.values())
    rows = language_model.score_documents(spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, chunk int")).collect()
    for r in rows:
        ws = words[r["doc_id"]]
        score = backs = 0
        for i, w in enumerate(ws):
            if i and two[ws[i - 1], w] >= 2:
                score += math.log(two[ws[i - 1], w] / one[ws[i - 1]])
            else:
                score += math.log(one[w] / total) + (math.log(0.4) if i else 0)
                backs += i > 0
        assert (r["n_words"], r["n_backoff"]) == (len(ws), backs) and abs(r["log_score"] - score) < 1e-6 * max(1, abs(score))
        assert (r["mean_log_score"] is None) == (not ws)
    assert len(rows) == len(texts)
    assert language_model.score_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("order, min_count", [(1, 2), (3, 2), (3, 1), (4, 3)])
def test_language_model_of_an_order_equals_the_definition(spark, order, min_count):
    rng = random.Random(order)
    texts = [None, "", "one", "a b", *(" ".join(rng.choice("abcde") for _ in range(rng.randint(1, 40))) for _ in range(20)), "aa " * 500]
    words = [words_of(t) for t in texts]
    count = Counter(tuple(ws[i: i + k]) for ws in words for k in range(1, order + 1) for i in range(len(ws) - k + 1))
    total = sum(map(len, words))

    def scored(gram):  # log score and backoff steps of its last word
        if len(gram) == 1:
            return math.log(count[gram] / total), 0
        if count[gram] >= min_count:
            return math.log(count[gram] / count[gram[:-1]]), 0
        score, steps = scored(gram[1:])
        return score + math.log(0.4), steps + 1

    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in language_model.score_documents(docs.repartition(3), min_count=min_count, order=order).collect():
        each = [scored(tuple(words[r["doc_id"]][max(0, i - order + 1): i + 1])) for i in range(r["n_words"])]
        assert r["n_backoff"] == sum(s for _, s in each) and abs(r["log_score"] - sum(x for x, _ in each)) < 1e-6


def test_language_model_reads_two_words_of_context(spark):
    texts = ["a x p"] * 2 + ["b x q"] * 2 + ["a x q", "b x p", "c x p", "c x q", "a x", "b x"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["log_score"] for r in language_model.score_documents(docs, order=3).collect()}
    assert got[0] > got[4] + 0.5  # the same words and pair counts but for the word two back


# -------------------------------------------------------------------- classifiers

@pytest.mark.parametrize("score, label, folds, held, precision, recall", [
    (toxicity.toxic_scores, "toxic", 5, 0, 0.85, 0.5), (quality.quality_scores, "quality", 3, 1, 0.95, 0.95)])
def test_held_out_accuracy(spark, score, label, folds, held, precision, recall):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    out = score(docs.select("doc_id", "text"), labels, fold("doc_id", folds) != held)
    rows = out.join(labels, "doc_id").where(fold("doc_id", folds) == held).select("predicted", label).collect()
    hit = sum(p and y for p, y in rows)
    assert hit / sum(p for p, _ in rows) >= precision and hit / sum(y for _, y in rows) >= recall


def test_quality_weights_follow_the_class_ratio_only(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(i, i % 2, " ".join(rng.choice(("good", "fine", "plain") if i % 2 else ("bad", "poor", "plain")) for _ in range(30))) for i in range(40)]
    drawn = spark.createDataFrame(rows, "doc_id long, y int, text string").withColumn("text", F.encode("text", "utf-8"))
    trained = []
    for times in (1, 60):
        monkeypatch.setattr(quality, "sample", lambda *_, k=times: (drawn, {0: 100 * k, 1: 300 * k}))
        trained.append(quality.train(drawn, drawn, "y", F.lit(True), per_class=20))
    assert abs(trained[0]).max() > 0 and abs(trained[0] - trained[1]).max() < 1e-9


@pytest.mark.parametrize("score", [toxicity.toxic_scores, quality.quality_scores])
def test_classifiers_on_odd_rows(spark, score):
    docs = spark.createDataFrame([(1, None, "l"), (2, "", "l"), (None, "x", "l"), (3, "w" * 100000, "l"), (3, "again " * 20000, "l")], "doc_id long, text string, y string")
    labels = spark.createDataFrame([(1, 1, 0), (2, None, None), (None, 1, 1), (3, 0, 1), (3, 1, 1)], "doc_id long, quality int, toxic int")
    for own in (labels, labels.limit(0), labels.where("toxic = 0")):
        rows = score(docs, own, F.lit(True)).collect()
        assert len(rows) == 5 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert score(docs.limit(0), labels, F.lit(True)).collect() == []


def test_kept_text_digest_is_of_joined_words():
    assert hashlib.sha256(b"a b").hexdigest() == hashlib.sha256(" ".join(words_of(" a\t b ")).encode()).hexdigest()


# ------------------------------------------------------------------ toxicity

def kneser_ney(words, order, discount):
    """Log-likelihood difference of a word per character, straight from the definition over (toxic, word, documents)."""
    def gram(s, i):
        return s[max(0, i - order + 1): i + 1]

    top = Counter()
    for y, word, n in words:
        s = f"^{word}$"
        for i in range(1, len(s)):
            top[y, gram(s, i)] += n
    seen = {g[k:] for _, g in top for k in range(len(g))}
    letters = {g for g in seen if len(g) == 1 and any(len(o) > 1 and o.endswith(g) for o in seen)}

    def left(g):
        return sum(1 for o in seen if len(o) == len(g) + 1 and o[1:] == g)

    def lower(g):
        if not g:
            return 1 / (len(letters) + 1)
        after = [left(o) for o in seen if len(o) == len(g) and o[:-1] == g[:-1]]
        if not sum(after):
            return lower(g[1:])
        return (max(left(g) - discount, 0) + discount * sum(1 for n in after if n) * lower(g[1:])) / sum(after)

    def p(y, g):
        after = [n for (c, o), n in top.items() if c == y and len(o) == len(g) and o[:-1] == g[:-1]]
        if not after:
            return lower(g[1:])
        return (max(top[y, g] - discount, 0) + discount * len(after) * lower(g[1:])) / sum(after)

    def evidence(word):
        s = f"^{word}$"
        return sum(math.log(p(1, gram(s, i)) / p(0, gram(s, i))) for i in range(1, len(s))) / (len(word) + 1)

    return evidence


@pytest.mark.parametrize("order", [2, 3, 5])
def test_toxicity_model_equals_kneser_ney(order):
    rng = random.Random(order)
    words = [(rng.randrange(2), "".join(rng.choice("abcd") for _ in range(rng.randrange(1, 8))), rng.randrange(1, 5)) for _ in range(40)]
    counts = {}
    for y, word, n in words:
        for g in toxicity.grams_of(word, order):
            counts.setdefault(g, [0, 0])[y] += n
    model = toxicity.Model([(g, *both) for g, both in counts.items()], order, 0.75)
    direct = kneser_ney(words, order, 0.75)
    for word in [w for _, w, _ in words] + ["", "e", "abcde", "dcbaabcd", "aaaaaaaaaaaa", "^$", "xyz"]:
        assert abs(model.evidence(word) - direct(word)) < 1e-9


def test_toxicity_keeps_columns_of_any_name(spark):
    rows = [(i, "mild weather today" if i % 2 else "you rotten scum", i, "x") for i in range(60)] + [(None, None, 1, "y"), (99, "", 2, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __evidence long, __score string")
    labels = docs.select("doc_id", (1 - F.col("doc_id") % 2).cast("int").alias("toxic")).where("doc_id < 40 and doc_id <> 98")
    kept = toxicity.keep_clean(docs, labels, F.lit(True))
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["text"]) == list(range(1, 60, 2))
    assert toxicity.keep_clean(docs.limit(0), labels, F.lit(True)).collect() == []
