import random
from collections import defaultdict

import regex

from lakeshift.llm import decontamination as d

ITEM = "tom has 12 apples and gives 5 apples to mary before he walks 3 km to the market"


def bench(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def found(docs, b, **more):
    return {(r.id, r.item_id) for r in d.matches(docs, b, **more).collect()}


def test_templates(spark):
    from pyspark.sql import functions as F

    rows = [("He saw Mary run 5 km.", "he saw ⟨p⟩ run ⟨n⟩ ⟨u⟩"), ("A b. Cd e", "a b cd e"), ("3.5kg of X1, y", "⟨n⟩ of ⟨n⟩ y"), ("", ""), ("m km", "m km"), ("x 12 m\ny", "x ⟨n⟩ ⟨u⟩ y"), ("é ⟨n⟩", "é n⟩")]
    got = spark.createDataFrame(rows, "x string, y string").select(F.array_join(d.template(F.col("x")), " ").alias("t"), "y").collect()
    assert [r.t for r in got] == [r.y for r in got]


def test_other_numbers_and_names_are_found(spark, docs_of):
    text = "In this tale tom has 12 apples and gives 5 apples to mary before he walks 3 km to the market today"
    docs = docs_of([
        (1, text), (2, text.replace("12", "40").replace("5 ", "17 ").replace("km", "miles")), (3, text.replace("apples", "pears")), (4, "nothing of this kind is here at all, nor anything like it"),
        (5, None), (6, ""), (1, text), (None, text), (7, "before " + ITEM.upper()),
    ])
    assert found(docs, bench(spark, ITEM)) == {(1, 0), (2, 0), (7, 0), (None, 0)}
    assert d.matches(docs, bench(spark, ITEM)).count() == 4


def test_slots_must_be_consistent(spark, docs_of):
    item = "there are 7 red balls and 7 blue balls in a box so we take 7 balls out of the box now"
    same = item.replace("7", "9")
    mixed = "there are 1 red balls and 2 blue balls in a box so we take 3 balls out of the box now"
    assert found(docs_of([(1, same), (2, mixed)]), bench(spark, item)) == {(1, 0)}


def test_classes_of_items(spark, docs_of):
    b = bench(spark, ITEM, ITEM.replace("12", "13"), None, "too short")
    rows = d.matches(docs_of([(1, ITEM)]), b).collect()
    assert [(r.item_id, r.n_items) for r in rows] == [(0, 2)]
    short = bench(spark, ITEM, "seven words that are in here alone", "only six words are in here")
    assert found(docs_of([(1, ITEM), (2, "so seven words that are in here alone it is"), (3, "and only six words are in here"), (4, "words that are in here")]), short) == {(1, 0), (2, 1), (3, 2)}


def brute(docs, items, w=8):
    out = set()
    for d_, t in docs:
        tokens = (t or "").lower().split()
        have = {tuple(tokens[k : k + w]) for k in range(len(tokens) - w + 1)}
        for i, x in items:
            y = x.lower().split()
            own = {tuple(y[k : k + w]) for k in range(len(y) - w + 1)}
            if len(have & own) >= min(6, len(own)):
                out.add((d_, i))
    return out


def test_planted_items_are_found(spark):
    sf = "/root/testdata/sf0.01"
    docs, b = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in b.collect()])
    assert found(docs, b) == want and len(want) > 10


def test_large_benchmarks_are_shuffled(spark, docs_of):
    rng = random.Random(1)
    texts = [" ".join(f"w{rng.randrange(10**6)}" .replace("0", "o").translate(str.maketrans("123456789", "abcdefghi")) for _ in range(20)) for _ in range(30)]
    docs = docs_of([(k, "start " + t + " end") for k, t in enumerate(texts)])
    assert found(docs, bench(spark, *texts), broadcast_rows=10) == {(k, k) for k in range(30)}


def test_odd_rows(spark, odd_docs, docs_of):
    b = bench(spark, ITEM)
    assert d.matches(odd_docs, b).count() == 0 and d.matches(docs_of([]), b).count() == 0 and d.matches(odd_docs, b.limit(0)).count() == 0
    kept = d.decontaminated(odd_docs, b)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    assert d.decontaminated(docs_of([(None, ITEM), (1, "x"), (2, ITEM)]), b).collect()[0].doc_id == 1


def test_no_python_in_the_plan(spark, sf):
    plan = d.op9_decontaminate(spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_one_consistent_occurrence_is_enough(spark, docs_of):
    item = "there are 7 red balls and 8 blue balls in a box so we take 9 balls out of the box now"
    other, third = (item.replace("7", a).replace("8", b).replace("9", c) for a, b, c in (("31", "32", "33"), ("41", "42", "43")))
    torn = "there are 1 red balls and 2 blue balls in a box so we take 3 balls out of the box now"
    docs = docs_of([(1, f"{item} and then {other}"), (2, f"{other} as well as {third}"), (3, torn)])
    assert found(docs, bench(spark, item)) >= {(1, 0), (2, 0)}
    same = item.replace("8", "7").replace("9", "7")
    assert found(docs_of([(3, torn), (4, f"{torn} {torn}")]), bench(spark, same)) == set()


def test_items_without_template_windows(spark, docs_of):
    items = ["12 + 13 = 25 and 14 + 15 = 29", "Paris is big", "Ann Bob Carl Dora Emil Fay Gus Hal Ida Jon"]
    docs = docs_of([(1, f"so {items[0]} it is"), (2, "he said paris is big today"), (3, "the list: " + items[2] + " end"), (4, "12 + 13 = 26 and 14 + 15 = 29"), (5, "paris is a big town")])
    assert found(docs, bench(spark, *items)) == {(1, 0), (2, 1), (3, 2)}


def test_case_and_place_of_items(spark, docs_of):
    short, long = "What is the sum of all these numbers", "Today Alice Brown went to see Robert Green in the old town near Mary Field for 3 days"
    docs = docs_of([(1, "read this - What is the sum of all these numbers"), (2, "ask, What is the sum of all these numbers"), (3, "x " + long.lower()), (4, "x " + long.replace(" ", "\n")), (5, "x " + long.replace(" ", "  "))])
    assert found(docs, bench(spark, short, long)) == {(1, 0), (2, 0), (3, 1), (4, 1), (5, 1)}
    numbered = "What do 5 apples and some pears cost in total"
    assert found(docs_of([(1, "read this - What do 6 apples and some pears cost in total")]), bench(spark, numbered)) == {(1, 0)}


def canonical(text, values=False):
    """The template's tokens in plain Python."""
    kept = (lambda kind: lambda m: f"{d.MARK}{kind}⟩{m[0]}") if values else (lambda kind: lambda m: f"{d.MARK}{kind}⟩")
    x = regex.sub(r"[\t-\r][ \t-\r]*| [ \t-\r]+", " ", text.replace(d.MARK, ""))
    if regex.search("[0-9]", x):
        x = regex.sub(r"(?<!\S)\S*[0-9]\p{L}*", kept("n"), x)
        x = regex.sub(rf"(?<=[0-9⟩\p{{L}}] )(?<={d.MARK}n⟩\S{{0,40}} )(?i:{d.UNITS})(?!\p{{L}})", kept("u"), x)
    x = regex.sub(r"\p{Lu}(?<=[^.!?:;\s] .)[\p{Ll}\p{M}'’-]+(?!\p{L})", kept("p"), x)
    return regex.sub(r"[.,;:!?\"()\[\]|]+", "", x.lower()).split()


def plain(text):
    return regex.sub(r"[.,;:!?\"()\[\]|]+", "", text.replace(d.MARK, "").lower()).split()


def cut(tokens, n):
    return [tuple(tokens[k : k + n]) for k in range(len(tokens) - n + 1)] if n else []


def whole_brute(docs, items):
    """(doc, item) by templates, slots and literal windows, one after another."""
    classes, out = {}, set()
    kept = [(doc, canonical(t or ""), canonical(t or "", True), plain(t or "")) for doc, t in docs]
    have, literal = defaultdict(lambda: defaultdict(list)), defaultdict(lambda: defaultdict(list))  # places of windows, by document
    for k, (_, a, _, b) in enumerate(kept):
        for n in range(1, d.WINDOW + 1):
            for index, words in ((have, a), (literal, b)):
                for p, w in enumerate(cut(words, n)):
                    index[w][k].append(p)
    for i, x in items:
        classes.setdefault(tuple(canonical(x)), []).append((i, x))
    for key, members in classes.items():
        item, text = min(members)
        n, tagged = min(len(key), d.WINDOW), canonical(text, True)
        windows = [(k, w) for k, w in enumerate(cut(key, n)) if n - sum(t.startswith(d.MARK) for t in w) >= min(d.LITERALS, n - 1)] if len(key) >= d.LEAST_TOKENS else []
        other = cut(canonical("a " + text.lstrip())[1:], n)[:1]
        want = min(d.MIN_WINDOWS, len({w for _, w in windows}))
        units = {tuple(plain(x)) for _, x in members}
        some = {j for w in [*(w for _, w in windows), *other] for j in have.get(w, ())}
        for j in some:
            doc, _, values, _ = kept[j]
            at = lambda w: have[w][j] if w in have and j in have[w] else []  # noqa: B023, E731
            hits = [(k, p, w) for k, w in windows for p in {*at(w), *(at(other[0]) if k == 0 and other else [])}]
            slots = lambda some: {(tagged[k + j], values[p + j]) for k, p, w in some for j in range(n) if tagged[k + j].startswith(d.MARK)}  # noqa: B023, E731
            agree = lambda some: len(s := slots(some)) == len({a for a, _ in s})  # noqa: B023, E731
            enough = lambda some: len({w for _, _, w in some}) >= want  # noqa: B023, E731
            if want and enough(hits):
                shifts, runs = sorted({p - k for k, p, _ in hits}), []
                for s in shifts:
                    if runs and s - runs[-1][-1] <= d.GAP:
                        runs[-1].append(s)
                    else:
                        runs.append([s])
                groups = [hits] + [g for r in [*runs, *([s] for s in shifts)] if enough(g := [h for h in hits if h[1] - h[0] in r])]
                if any(map(agree, groups)):
                    out.add((doc, item))
        for u in units:
            own = set(cut(u, min(len(u), d.WINDOW)))
            counts = defaultdict(int)
            for w in own:
                for j in literal.get(w, ()):
                    counts[j] += 1
            out |= {(kept[j][0], item) for j, c in counts.items() if c >= min(d.MIN_WINDOWS, len(own))}
    return out


def test_against_brute_force_with_templates_and_slots(spark):
    """All documents and items of a table, with items of numbers, names and units planted as they are, with other and with torn values."""
    sf, rng = "/root/testdata/sf0.01", random.Random(6)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    low = [w.lower() for _, t in docs[:50] for w in (t or "").split() if w.isalpha()]
    names = ["Anna", "Boris", "Chloe", "Dmitri", "Elena"]
    for k in range(40):
        words = [rng.choice(low) for _ in range(rng.randrange(7, 30))]
        for at in rng.sample(range(len(words)), rng.randrange(1, min(7, len(words)))):
            words[at] = rng.choice([rng.choice("123"), rng.choice(names[:2]), f"{rng.choice('45')} km"])
        item = " ".join(words)
        items.append((10_000 + k, item))
        swap = {**dict(zip("12345", rng.sample(["31", "7", "88", "9.5", "60"], 5), strict=True)), "Anna": "Chloe", "Boris": "Elena", "km": "miles"}
        same = " ".join(swap.get(w, w) for w in item.split())
        torn = " ".join(str(rng.randrange(100, 999)) if w in "12345" else w for w in item.split())
        near = " ".join(w for j, w in enumerate(same.split()) if j != 3)
        around = lambda x: " ".join([*rng.choices(low, k=9), x, *rng.choices(low, k=9)])
        docs += [(10**6 + 10 * k + j, around(x)) for j, x in enumerate([item, same, torn, near, f"{torn} {same}", item.upper()])]
    got = found(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    want = whole_brute(docs, items)
    assert got == want
    some = [x for x in docs if x[0] % 3 == 0]
    assert found(spark.createDataFrame(some, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), broadcast_rows=0) == {x for x in want if x[0] % 3 == 0}
    assert len({x for x in want if x[0] >= 10**6}) > 120 and all((10**6 + 10 * k, 10_000 + k) in want for k in range(40))


def test_no_conflict_is_tolerated(spark, docs_of):
    item = "we take 7 red and 7 blue then 7 more of green and 7 of the white and 7 grey and 7 black balls"
    torn = item
    for v in "123456":
        torn = torn.replace(" 7 ", f" {v} ", 1)
    one_off = item.replace(" 7 ", " 4 ").replace(" 4 black", " 5 black")
    assert found(docs_of([(1, torn), (2, item.replace("7", "4")), (3, one_off)]), bench(spark, item)) <= {(2, 0), (3, 0)}
    assert (2, 0) in found(docs_of([(2, item.replace("7", "4"))]), bench(spark, item))


def test_verbatim_items_of_any_kind(spark, docs_of):
    items = ["compute 12 + 35 * 4 - 7 + 18 / 3 + 22 - 9", " ".join(map(str, range(12, 60, 11))) + " 33 44", "what is two", "?!"]
    docs = docs_of([(k, f"some words before {x} and some after") for k, x in enumerate(items)])
    assert found(docs, bench(spark, *items)) == {(0, 0), (1, 1), (2, 2)}


def test_many_equal_rows(spark, docs_of):
    docs = docs_of([(None, "x " + ITEM.replace("12", "40"))] * 300 + [(1, "clean")])
    assert d.matches(docs, bench(spark, ITEM)).count() == 1 and d.decontaminated(docs, bench(spark, ITEM)).count() == 1
