import random

from helpers import documents, edit_distance, rows_of

from hopdex.llm import decontaminate
from hopdex.llm.decontaminate import Pattern, find_contamination, normal, pieces_of


def within(item, text):
    """Smallest edit distance of the item and any stretch of the text, by the full table."""
    before = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        now = [i]
        for j, b in enumerate(text, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (a != b)))
        before = now
    return min(before)


def corpus():
    rng = random.Random(8)
    char = lambda: rng.choice("abcdeé  ")
    text = lambda n: "".join(char() for _ in range(n))
    items = [(i, text(rng.randint(20, 90))) for i in range(8)]
    rows = []
    for i in range(60):
        item = list(rng.choice(items)[1])
        for _ in range(rng.randint(0, 9)):
            at = rng.randrange(len(item))
            item[at: at + rng.randint(0, 1)] = [char() for _ in range(rng.randint(0, 1))]
        rows.append((i, text(rng.randint(0, 200)) + "".join(item).upper() + "\n" + text(rng.randint(0, 100))))
    rows += [(70, None), (71, ""), (None, items[0][1]), (72, items[1][1]), (72, items[1][1]), (73, text(20_000) + items[2][1])]
    return rows, items + [(20, None), (21, ""), (22, "   "), (23, "abc"), (0, items[0][1])]


def test_matches_brute_force(spark):
    rows, items = corpus()
    table = spark.createDataFrame([(i, t, "k") for i, t in items], "item_id long, text string, k_id string")
    found = rows_of(find_contamination(documents(spark, rows), table, error_rate=0.1), "doc_id", "item_id", "distance")
    expected = []
    for doc, text in rows:
        for item_id, item in {(i, normal(t)) for i, t in items if t and normal(t)}:
            best = within(item, normal(text or ""))
            if best <= int(len(item) * 0.1):
                expected.append((doc, item_id, best))
    assert found == sorted(expected, key=repr)
    assert len({d for _, _, d in found}) > 3


def test_passes_of_bounded_size(spark, monkeypatch):
    rows, items = corpus()
    table = spark.createDataFrame(items, "item_id long, text string")
    whole = rows_of(find_contamination(documents(spark, rows), table), "doc_id", "item_id", "distance", "end")
    monkeypatch.setattr(decontaminate, "PASS_ITEMS", 3)
    assert rows_of(find_contamination(documents(spark, rows), table), "doc_id", "item_id", "distance", "end") == whole


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "abcdefgh")], "item_id long, text string")
    assert find_contamination(documents(spark, [(1, "abcdefgh")]), none).collect() == []
    assert find_contamination(documents(spark, []), some).collect() == []


def test_myers():
    rng = random.Random(5)
    for _ in range(300):
        item = "".join(rng.choice("abc") for _ in range(rng.randint(1, 70)))
        text = "".join(rng.choice("abc") for _ in range(rng.randint(0, 80)))
        distance, end = Pattern(item, 0).best(text)
        assert distance == min(within(item, text), len(item))
        if distance < len(item):
            assert min(edit_distance(item, text[a:end]) for a in range(end + 1)) == distance


def test_pieces():
    assert "".join(p for _, p in pieces_of("abcdefghij", 3)) == "abcdefghij"
    assert len(pieces_of("abcdefghij", 3)) == 4


def test_distance_up_to_a_bound():
    rng = random.Random(3)
    for _ in range(300):
        a, b = ("".join(rng.choice("abé") for _ in range(rng.randint(1, 14))) for _ in range(2))
        whole, most = Pattern(a, 0).distance(b), rng.randrange(12)
        near = Pattern(a, 0).distance(b, most)
        assert near == whole if whole <= most else near > most
