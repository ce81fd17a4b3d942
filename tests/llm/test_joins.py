"""Jaccard join and decontamination against brute force and by hand."""

import random
import re

import pytest

from marketlens.llm import decontaminate, jaccard_join
from marketlens.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_sets(texts, size=5):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = []
    for text in texts:
        words = WORD.findall((text or "").translate(lower))
        out.append({tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set())
    return out


def brute_components(ids, texts):
    sets, parent = brute_sets(texts), list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    linked = [0] * len(texts)
    for a in range(len(texts)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 75 * len(sets[a] | sets[b]):
                linked[a] += 1
                linked[b] += 1
                parent[root(a)] = root(b)
    least = {}
    for i, x in enumerate(ids):
        if x is not None:
            least[root(i)] = min(x, least.get(root(i), x))
    return [(x, len(sets[i]), least.get(root(i)), linked[i]) for i, x in enumerate(ids)]


def corpus(seed=3):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["Straße", "ÀB", "x,y"]
    base = [[draw.choice(vocabulary) for _ in range(draw.randint(1, 80))] for _ in range(60)]
    texts = [" ".join(words) for words in base]
    for words in base[:30]:
        for _ in range(draw.randint(1, 6)):
            copy = list(words)
            for _ in range(draw.randint(0, 3)):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            texts.append(draw.choice([" ", "\n", "\t "]).join(copy).upper() if draw.random() < 0.2 else " ".join(copy))
    passage = " ".join(f"p{i}" for i in range(40))
    texts += [f"{passage} " + " ".join(draw.choices(vocabulary, k=draw.randint(2, 60))) for _ in range(30)]
    return texts + ["", None, "   ", "one two", "One  two", "a b c d e", None]


@pytest.mark.parametrize("block", [1024, 7])
def test_jaccard_join_equals_brute_force(spark, monkeypatch, block):
    texts = corpus()
    ids = list(range(1000, 1000 + len(texts)))
    random.Random(5).shuffle(ids)
    rows = list(zip(ids, texts, ["x"] * len(ids), strict=True))
    rows += [rows[0], rows[70], (None, texts[3], "y"), (None, None, "y")]
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    # columns named like those the job makes
    docs = spark.createDataFrame(rows, "doc_id long, text string, tokens string").repartition(5)
    got = jaccard_join.jaccard_join(docs)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "n_links"]
    expected = brute_components([r[0] for r in rows], [r[1] for r in rows])
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(expected, key=key)


def test_jaccard_join_of_nothing_and_of_a_long_text(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard_join.jaccard_join(empty).count() == 0
    long = " ".join(str(i) for i in range(120_000))
    docs = spark.createDataFrame([(1, long), (2, long + " end"), (3, "short")], "doc_id long, text string")
    assert sorted(map(tuple, jaccard_join.jaccard_join(docs).collect())) == [
        (1, 119_996, 1, 1),
        (2, 119_997, 1, 1),
        (3, 1, 3, 0),
    ]


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3), (200, 201)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


ITEM = "A train leaves the old station at 9 km per hour and meets Alice near the bridge after 3 hours of slow travel"


def found(spark, docs, items=((1, ITEM),)):
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(docs)], "doc_id long, text string, hash string")
    bench = spark.createDataFrame(list(items), "item_id long, text string")
    return sorted((r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect())


def test_decontamination_by_template(spark):
    changed = ITEM.replace("9", "12").replace("Alice", "Bob").replace("3 hours", "7 hours")
    docs = [
        f"before {ITEM} after",
        f"Some words. {changed} and more",
        ITEM.upper().lower(),
        "A train leaves the old station and nothing else is alike here at all in any way",
        "",
        None,
    ]
    assert found(spark, docs) == [(0, 1), (1, 1), (2, 1)]


def test_values_must_agree(spark):
    item = "first 5 apples then 5 pears then 5 plums then 5 figs then 5 dates then 5 nuts"
    same, other = item.replace("5", "8"), item
    for value in "123469":
        other = other.replace("5", value, 1)
    assert found(spark, [same, other], [(1, item)]) == [(0, 1)]


NUMBERS = (
    "anna buys 3 apples and 4 pears then sells 5 plums for 6 coins each while her brother keeps 7 figs "
    "and 8 dates so they share 9 nuts or 2"
)


def test_values_agree_within_an_occurrence(spark):
    # some new values sort before the old ones, some after
    variant = re.sub(r"\d", lambda d: "1" + d[0] if int(d[0]) % 2 else d[0] + "0", NUMBERS)
    shifted = variant.replace("then sells", "then now sells")
    docs = [NUMBERS, variant, f"{NUMBERS}. Or else: {variant}", f"{variant} {variant.replace('1', '3')}", f"x {shifted} y {variant}"]
    assert found(spark, docs, [(1, NUMBERS)]) == [(i, 1) for i in range(5)]
    frame = spark.createDataFrame([(1, docs[2])], "doc_id long, text string")
    bench = spark.createDataFrame([(1, NUMBERS)], "item_id long, text string")
    row = decontaminate.contaminated(frame, bench).first()
    assert row.matched == row.item_windows
    assert decontaminate.decontaminate(frame, bench).count() == 0


def test_names_that_begin_a_sentence(spark):
    tom = "Tom has 3 apples. Tom buys 5 apples. Tom eats 2 apples. Tom sells 4 apples. How many apples are left?"
    ann, quoted = tom.replace("Tom", "Ann"), tom.replace("Tom", '"Ann"')
    inside = "Here Ann has 3 apples, Ann buys 5 apples, Ann eats 2 apples, Ann sells 4 apples. How many apples are left?"
    several = tom
    for name in ("Ann", "Bob", "Eve", "Max"):
        several = several.replace("Tom", name, 1)
    lower = tom.lower()
    other = "Tim finds 3 books. Kim reads 5 pages. Tim writes 2 letters. Kim burns 4 houses. Why do they never stop?"
    docs = [tom, ann, quoted, inside, several, lower, other, f"- {ann}\n({tom})"]
    assert found(spark, docs, [(1, tom)]) == [(i, 1) for i in (0, 1, 2, 3, 5, 7)]


def test_decontamination_keeps_clean_rows(spark):
    rows = [(1, f"x {ITEM}", "a"), (2, "clean text", "b"), (2, "clean text", "b"), (None, None, "c"), (4, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(1, ITEM), (2, None), (3, "")], "item_id long, text string")
    kept = decontaminate.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, docs.where("doc_id is null or doc_id <> 1").collect()))
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(docs, nothing).count() == 5
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0


def test_joins_agree_when_nothing_is_broadcast(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    monkeypatch.setattr(decontaminate, "BROADCAST_DOCUMENTS", 0)
    assert found(spark, [f"before {ITEM} after", "clean"]) == [(0, 1)]


def test_decontamination_keeps_columns_of_its_own_names(spark):
    item = "how many red apples does a farmer with twelve trees sell on each market day"
    docs = spark.createDataFrame([(1, item, "k1", 5), (2, "nothing of the kind is in this text at all", "k2", 6)], "doc_id long, text string, _key string, place int")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert [tuple(r) for r in decontaminate.decontaminate(docs, bench).collect()] == [tuple(docs.collect()[1])]
