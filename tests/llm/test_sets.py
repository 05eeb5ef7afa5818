"""Joins, groups and scores against brute force over small, hostile tables."""

import random
import re
import zlib

import numpy as np
import pytest

from refinery.llm import decontaminate, jaccard, language_model, linking, quality, repeats, topk

rnd = random.Random(7)
VOCABULARY = [f"w{k}" for k in range(60)]


def words(n):
    return [rnd.choice(VOCABULARY) for _ in range(n)]


def family(base, copies, most):
    """Near copies of one text, each with up to ``most`` words changed."""
    for _ in range(copies):
        text = list(base)
        for _ in range(rnd.randint(0, most)):
            text[rnd.randrange(len(text))] = rnd.choice(VOCABULARY)
        yield " ".join(text)


def corpus():
    texts = [t for size in (1, 2, 3, 8, 40, 120) for t in family(words(size), 25, max(1, size // 15))]
    shared = " ".join(words(60))
    texts += [f"{shared} {' '.join(words(rnd.randint(1, 12)))}" for _ in range(40)]
    texts += ["", None, "A b\tC", "a  b c", "x"] * 2
    return list(enumerate(texts))


def components(links, ids):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {i: find(i) for i in ids}


def shingles(text, n):
    w = (text or "").encode().lower().split()
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} - {()}


@pytest.mark.parametrize("options", [{}, {"n": 5, "percent": 80}, {"n": 2, "percent": 60, "sketch_bits": 3, "bitmap_words": 1}])
def test_jaccard_classes(spark, options):
    rows = corpus()
    settings = jaccard.Settings(**options)
    sets = {i: shingles(t, settings.n) for i, t in rows}
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= settings.percent * len(sets[a] | sets[b])
    ]
    want = components(links, sets)
    out = jaccard.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string"), settings=settings)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out.collect()} == {
        i: (len(sets[i]), want[i]) for i in sets
    }


def test_components_of_chains_and_stars(spark):
    chain = [(k, k + 1) for k in range(0, 90)] + [(500 - k, 499 - k) for k in range(90)]
    star = [(1000, 1001 + k) for k in range(50)] + [(2000, 2000)]
    ids = {i for pair in chain + star for i in pair} - {2000}
    found = linking.connected_components(spark.createDataFrame(chain + star, "a long, b long"))
    assert {r["node"]: r["component"] for r in found.collect()} == components([e for e in chain + star if e[0] != e[1]], ids)


def test_repeated_paragraphs(spark):
    bases = [words(30) for _ in range(4)]
    rows = [(k, f"{' '.join(words(25))}\n{next(family(bases[k % 4], 1, 1))}\nshort line") for k in range(40)]
    settings = repeats.Settings()
    held = {}
    for i, text in rows:
        for k, line in enumerate(text.split("\n")):
            w = line.split()
            if len(w) >= settings.least_words:
                held[i, k] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)}
    links = [(a, b) for a in held for b in held if a < b and 10 * len(held[a] & held[b]) >= 8 * len(held[a] | held[b])]
    want = components(links, held)
    sizes = {}
    for root in want.values():
        sizes[root] = sizes.get(root, 0) + 1
    out = repeats.repeated_paragraphs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = {(r["doc_id"], r["paragraph"]): r["component_id"] for r in out}
    assert set(found) == {x for x, root in want.items() if sizes[root] > 1}
    assert len({(found[x], want[x]) for x in found}) == len(set(found.values())) == len({want[x] for x in found})
    assert sorted((r["doc_id"], r["paragraph"]) for r in out if r["keep"]) == sorted({want[x] for x in found})


def fresh(prefix, n):
    return [f"{prefix}{k}" for k in range(n)]


def test_passages_inside_lines_and_across_them(spark):
    inner, wrapped, near = fresh("p", 60), fresh("q", 60), fresh("n", 60)
    lines = lambda ws, n: "\n".join(" ".join(ws[k : k + n]) for k in range(0, len(ws), n))
    changed = [*near[:30], "x", *near[31:]]
    rows = [
        (1, "é " + " ".join(fresh("a", 40) + inner + fresh("b", 40))),
        (2, " ".join(fresh("c", 40) + inner + fresh("d", 40))),
        (3, "é one\n\n" + lines(wrapped, 12)),
        (4, " ".join(fresh("e", 70)) + "\n\n" + lines(wrapped, 9)),
        (5, " ".join(fresh("f", 30) + wrapped + fresh("g", 90))),
        (6, lines(near, 12)),
        (7, lines(changed, 12)),
        (8, " ".join(fresh("h", 20) + inner[:49] + fresh("i", 20))),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = repeats.repeated_paragraphs(docs).collect()
    texts = dict(rows)
    said = {(r["doc_id"], " ".join(texts[r["doc_id"]][r["start"] : r["end"]].split()), r["keep"]) for r in out}
    assert said == {
        (1, " ".join(inner), True), (2, " ".join(inner), False),
        (3, " ".join(wrapped), True), (4, " ".join(wrapped), False), (5, " ".join(wrapped), False),
        (6, " ".join(near), True), (7, " ".join(changed), False),
    }
    left = {r["doc_id"]: r["text"].split() for r in repeats.without_repeats(docs).collect()}
    assert left[2] == fresh("c", 40) + fresh("d", 40)
    assert left[5] == fresh("f", 30) + fresh("g", 90) and left[7] == []
    assert all(left[k] == texts[k].split() for k in (1, 3, 6, 8))


def test_every_repeated_window_is_kept_once(spark):
    a, b = fresh("a", 55), fresh("b", 55)
    rows = [(1, " ".join(fresh("x", 60) + a)), (2, " ".join(b + fresh("y", 60))), (3, " ".join(a + fresh("z", 40) + b))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = {r["doc_id"]: r["text"].split() for r in repeats.without_repeats(docs).collect()}
    assert left == {1: rows[0][1].split(), 2: rows[1][1].split(), 3: fresh("z", 40)}


def test_bands_reach_the_recall():
    for threshold in (0.5, 0.8, 0.9):
        bands, rows = repeats.tune_bands(threshold, 0.99, 0.2)
        assert 1 - (1 - threshold**rows) ** bands >= 0.99


ITEM = "A farmer near Boston sold 24 baskets of ripe apples for 18 dollars and then walked 3 km back to the farm"


@pytest.mark.parametrize(
    ("text", "leaked"),
    [
        (ITEM, True),
        ("Intro words here.\n" + ITEM + ". And more.", True),
        (ITEM.upper().replace("BOSTON", "Boston"), True),
        ("A farmer near Paris sold 7 baskets of ripe apples for 99 dollars and then walked 12 km back to the farm", True),
        ("A farmer near Boston sold 24 baskets of ripe apples", False),
        ("A baker in Boston baked 24 loaves of fresh bread for 18 dollars and then drove 3 km to the lake", False),
        ("24 18 3 24 18 3 24 18 3 24 18 3", False),
    ],
)
def test_leaks(spark, text, leaked):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    items = spark.createDataFrame([(5, ITEM)], "item_id long, text string")
    assert decontaminate.leaks(docs, items).count() == int(leaked)


def test_leaks_read_the_documents_once(spark):
    docs = spark.createDataFrame([(1, ITEM)], "doc_id long, text string")
    items = spark.createDataFrame([(5, ITEM)], "item_id long, text string")
    found = decontaminate.leaks(docs, items)
    # The documents' windows are written once before the steps that read them; the result reads them from disk.
    assert "MapInArrow" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.count() == 1


def found_leaks(spark, item, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    return {r["doc_id"]: r["verbatim"] for r in decontaminate.leaks(docs, items).collect()}


def test_slots_must_be_consistent(spark):
    item = "take 5 red marbles and put 5 blue marbles into a box"
    texts = [item, item.replace("5", "8"), item.replace("5", "8", 1), item.replace("5", "8", 1).replace("5", "7")]
    # The third has three of five windows word for word; in the last both 5s differ, and no window without one is left.
    assert found_leaks(spark, item, texts) == {0: True, 1: False, 2: True}


def test_one_contradiction_does_not_hide_the_rest(spark):
    item = "take 5 red marbles and put 5 blue marbles into a box then count all marbles and add 9 more to it"
    # Thirteen and eleven of its fifteen windows are there word for word.
    assert found_leaks(spark, item, [item.replace("5", "8", 1), item.replace("9", "5")]).keys() == {0, 1}
    tom = "Tom walks 5 km to the shop near the old bridge and buys 3 kg of rice for his mother before the rain comes down"
    assert found_leaks(spark, tom, [tom.replace("5 km", "3 km"), tom.replace("3 kg", "5 kg")]).keys() == {0, 1}
    long = " ".join(words(150)) + " he had 4 of them then " + " ".join(words(150)) + " and 4 were left"
    assert found_leaks(spark, long, [long.replace("4", "6", 1)]).keys() == {0}


def test_every_run_of_eight_words_that_is_shared_counts(spark):
    """Against sets of all eight-word windows: enough of an item's windows word for word is always a leak."""
    small = random.Random(12)
    items = {k: " ".join(small.choices(VOCABULARY, k=small.randint(8, 40))) for k in range(30)}
    texts = []
    for _ in range(120):
        take = items[small.randrange(30)].split()
        start = small.randrange(len(take))
        piece = take[start : start + small.randint(4, 30)]
        texts.append(" ".join([*small.choices(VOCABULARY, k=5), *piece, *small.choices(VOCABULARY, k=5)]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    frame = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, frame).collect()}

    def windows(text):
        w = text.split()
        return {k: tuple(w[k : k + 8]) for k in range(len(w) - 7)}

    want = set()
    for d, text in enumerate(texts):
        have = set(windows(text).values())
        for i, item in items.items():
            shared = sum(window in have for window in windows(item).values())
            if shared >= 6 or shared >= 0.5 * len(windows(item)):
                want.add((d, i))
    assert got == want


@pytest.mark.parametrize(
    ("item", "text", "verbatim"),
    [
        ("Tom has 5 apples. Mary has 3 apples. How many apples do they have?",
         "Jack has 7 apples. Lucy has 9 apples. How many apples do they have?", False),
        ("Then Émile gave 5 of his red marbles to a friend. Ödön took 2 of them home to his brother.",
         "Then Óscar gave 8 of his red marbles to a friend. Jack took 3 of them home to his brother.", False),
        ("Solve: 3x + 4y = 12, 5x - 2y = 7.", "Now. Solve: 3x + 4y = 12, 5x - 2y = 7. Done", True),
    ],
)
def test_leaks_with_opening_names_and_with_few_words(spark, item, text, verbatim):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    items = spark.createDataFrame([(5, item)], "item_id long, text string")
    assert [r["verbatim"] for r in decontaminate.leaks(docs, items).collect()] == [verbatim]


def test_opening_names_must_be_consistent(spark):
    item = "Tom bought 5 ripe red apples. Tom then sold 3 green ones."
    other = item.replace("5", "7").replace("3", "9").replace("Tom", "Jack", 1)
    texts = [(1, other.replace("Tom", "Jack")), (2, other.replace("Tom", "Lucy"))]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    items = spark.createDataFrame([(5, item)], "item_id long, text string")
    assert [r["doc_id"] for r in decontaminate.leaks(docs, items).collect()] == [1]


def test_placeholders():
    kinds = decontaminate.canonical(["On Monday Anna Smith ran 5km, then 1,200.5 meters in twenty minutes."]).kinds.tolist()
    literal, number, name, unit = range(4)
    assert kinds == [literal, name, literal, number, unit, literal, number, unit, literal, number, unit]


def test_backoff_scores(spark):
    texts = [" ".join(words(rnd.randint(0, 30))) for _ in range(60)] + ["", None, "Only Once, here"]
    for order in (1, 2, 3):
        settings = language_model.Settings(order=order, batch_bytes=700, bucket_grams=50)
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        out = {r["doc_id"]: r["lm"] for r in language_model.with_backoff_scores(docs, settings=settings).collect()}
        w = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower()) for t in texts]
        counts = [{} for _ in w]
        for own, ws in zip(counts, w, strict=True):
            for n in range(1, order + 1):
                for k in range(len(ws) - n + 1):
                    gram = tuple(ws[k : k + n])
                    own[gram] = own.get(gram, 0) + 1
        total = {}
        for own in counts:
            for gram, n in own.items():
                total[gram] = total.get(gram, 0) + n
        all_words = sum(map(len, w))
        for i, ws in enumerate(w):
            rest, score = all_words - len(ws), 0.0

            def left(gram, i=i):
                return total.get(gram, 0) - counts[i].get(gram, 0)

            for k in range(len(ws)):
                value, factor = None, 1.0
                for n in range(min(order, k + 1), 1, -1):
                    gram = tuple(ws[k - n + 1 : k + 1])
                    if left(gram) > 0:
                        value = left(gram) / left(gram[:-1])
                        break
                    factor *= settings.alpha
                if value is None:
                    value = left((ws[k],)) / rest if left((ws[k],)) > 0 else 1 / (rest + 1)
                score += np.log(factor * value)
            assert out[i]["words"] == len(ws)
            assert out[i]["log_score"] == pytest.approx(score, abs=1e-6)


def test_search_in_many_blocks(spark):
    rng = np.random.default_rng(3)
    m = rng.normal(size=(300, 6)).astype(np.float32)
    m[rng.random(m.shape) < 0.5] = 0
    m[50:120] = m[50]
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id long, embedding array<float>")
    out = topk.top_inner_products(vectors, vectors.where("vec_id % 10 = 0"), k=7, block_rows=40, query_rows=8)
    whole = np.floor(m.astype(float) * 1024).astype(int)
    want = set()
    for q in range(0, 300, 10):
        scores = whole @ whole[q]
        order = sorted((i for i in range(300) if i != q), key=lambda i: (-scores[i], i))[:7]
        want |= {(q, rank, i, int(scores[i])) for rank, i in enumerate(order, 1)}
    assert {tuple(r) for r in out.select("query_id", "rank", "vec_id", "score").collect()} == want


def test_quality_learns_sums_and_pairs():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 4))
    y = ((x[:, 0] > 0.7) ^ ((x[:, 1] > 0.5) & (x[:, 2] > 0.5))).astype(float)
    model = quality.fit(x[:3000], y[:3000], quality.Settings(rounds=60, pair_rounds=60))
    accuracy = ((model.score(x[3000:]) >= 0.5) == y[3000:]).mean()
    alone = quality.fit(x[:3000], y[:3000], quality.Settings(rounds=60, pairs=0))
    assert accuracy > 0.9
    assert accuracy > ((alone.score(x[3000:]) >= 0.5) == y[3000:]).mean()


def test_held_out_rows(spark):
    ids = [(i,) for i in [*range(50), -3, None]]
    frame = spark.createDataFrame(ids, "doc_id long").select("doc_id", quality.held_out(quality.F.col("doc_id")).alias("h"))
    for i, h in frame.collect():
        assert h == (i is not None and zlib.crc32(str(i).encode()) % 5 == 0)


def test_variants_of_one_text_are_compared_in_proportion(spark, monkeypatch):
    """Near copies that are mostly not alike enough: what is left to verify grows with their number, not its square."""
    small = random.Random(21)
    base = [f"b{k}" for k in range(120)]
    counted = {}

    def variants(n):
        for k in range(n):
            text = list(base)
            for at in small.sample(range(120), small.choice([1, 2, 3, 3, 4, 4])):
                text[at] = f"v{k}x{at}"
            yield k, " ".join(text)

    keep = jaccard.keep_on_disk

    def counting(df, name):
        out = keep(df, name)
        if name == "candidates":
            counted[size] = counted.get(size, 0) + out.count()
        return out

    monkeypatch.setattr(jaccard, "keep_on_disk", counting)
    for size in (250, 2000):
        rows = list(variants(size))
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_classes(docs).collect()}
        if size == 250:
            sets = [{tuple(t.split()[i : i + 3]) for i in range(118)} for _, t in rows]
            links = [(a, b) for a in range(size) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])]
            assert got == components(links, range(size))
    assert counted[2000] <= 3 * 8 * counted[250]
