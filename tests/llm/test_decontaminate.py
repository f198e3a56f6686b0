import random
import string

import pyarrow as pa
from brute import prose

from smeltery.llm import decontaminate

EDGE = string.punctuation


def plain(text):
    found = (w.decode().strip(EDGE) for w in (text or "").encode().split())
    return ["".join(c.lower() if c.isascii() else c for c in w) for w in found if w]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def brute(texts, items, edits=0.2):
    out = {}
    for doc, text in enumerate(texts):
        found = plain(text)
        for item, content in items:
            want = plain(content)
            if not want:
                continue
            n = len(want)
            best = min((distance(found[k : k + n], want) for k in range(len(found) - n + 1)), default=n)
            if best <= int(edits * n):
                out[doc, item] = best
    return out


def case(seed=2):
    rng = random.Random(seed)
    known = [f"w{k}" for k in range(60)]
    items = [(k, prose(rng, rng.randrange(8, 40), known)) for k in range(12)]
    items += [(50, "One two!"), (51, "..."), (52, None), (53, items[0][1]), (54, "")]
    texts = ["", None, "one TWO", "!!! ...", "two one"]
    for _ in range(60):
        parts = rng.choice(items[:12])[1].split(" ")
        for _ in range(rng.randrange(0, 1 + len(parts) // 5)):
            kind, at = rng.randrange(3), rng.randrange(len(parts))
            if kind == 0:
                parts[at] = "edit"
            elif kind == 1:
                parts.insert(at, "more")
            else:
                del parts[at]
        texts.append(f"{prose(rng, 20, known)}\n{' '.join(parts).upper()}, {prose(rng, 15, known)}")
    return texts, items


def test_edited_items_are_found(spark, documents):
    texts, items = case()
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(texts, items)
    for block in (1 << 20, 50):
        rows = decontaminate.marked(documents(texts), bench, block_words=block).collect()
        got = {(r.doc_id, x.item_id): x.distance for r in rows for x in r.items}
        assert len(rows) == len(texts)
        assert all(want[k] <= d for k, d in got.items())
        assert len(got) >= 0.97 * len(want) > 40


def test_nothing_to_find(spark, documents):
    bench = spark.createDataFrame([], "item_id long, text string")
    odd = documents(["a b c", None]).withColumnRenamed("lang", "items").withColumnRenamed("source", "part")
    assert [r["items"] for r in decontaminate.marked(odd, bench).collect()] == [[], []]
    bench = spark.createDataFrame([(None, "a b c"), (1, "a b c")], "item_id long, text string")
    rows = decontaminate.marked(documents([(None, "x a b c", "en"), (2, "x a b c", "en")]), bench).collect()
    assert [len(r["items"]) for r in rows] == [2, 2]
    assert decontaminate.marked(documents([]), bench).collect() == []


def copies(rng, words, count):
    """Copies of ``words`` with as many words replaced as the limit allows."""
    for _ in range(count):
        parts = list(words)
        for at in rng.sample(range(len(parts)), len(parts) // 5):
            parts[at] = f"edit{rng.randrange(10**9)}"
        yield " ".join(parts)


def test_each_size_of_item_is_found_at_the_recall():
    rng = random.Random(5)
    sizes = [*range(8, 26, 2), 40, 59, 400]
    items = [[f"w{n}x{k}" for k in range(n)] for n in sizes]
    known = decontaminate.index(sizes, pa.array([" ".join(x) for x in items], pa.large_string()))
    for n, many in ((20, 1000), (40, 1000), (59, 1000), (400, 20)):
        k = sizes.index(n)
        texts = list(copies(rng, items[k], many))
        found = decontaminate.matches(known, pa.array(texts, pa.large_string()))
        hits = [f[k] for f in found if k in f]
        assert all(d <= n // 5 for d in hits)
        assert len(hits) >= 0.99 * many if n < 400 else len(hits) == many


def test_without_walks_nothing_is_missed():
    for seed in (2, 3):
        texts, items = case(seed)
        # Limits from 0.3 on leave no run of three words that must be shared.
        for edits in (0.2, 0.3):
            column = pa.array([x for _, x in items], pa.large_string())
            known = decontaminate.index([i for i, _ in items], column, edits, recall=1)
            found = decontaminate.matches(known, pa.array(texts, pa.large_string()))
            got = {(doc, known.ids[i]): d for doc, f in enumerate(found) for i, d in f.items()}
            assert got == brute(texts, items, edits)


def test_items_without_a_run_that_must_be_shared_are_found():
    # The middle word of five is replaced: no run of three words is left.
    items = [f"a{k} b{k} c{k} d{k} e{k}" for k in range(50)]
    texts = [f"x y a{k} b{k} other d{k} e{k} z" for k in range(50)]
    known = decontaminate.index(list(range(50)), pa.array(items, pa.large_string()))
    found = decontaminate.matches(known, pa.array(texts, pa.large_string()))
    assert sum(f == {k: 1} for k, f in enumerate(found)) >= 49
