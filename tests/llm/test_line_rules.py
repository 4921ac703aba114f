import re

from helpers import documents, rows_of

from hopdex.llm.line_rules import drop_frequent_lines, rate_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def normal(line):
    return re.sub(r"[0-9]", "0", re.sub(r"[\x20\x09\x0B-\x0D]+", " ", line.lower())).strip(" ")


def lines(text):
    return [x for x in map(normal, (text or "").split("\n")) if x]


def holders_of(rows):
    holders = {}
    for doc, text, host in {(d, t, s) for d, t, s in rows}:
        for line in set(lines(text)):
            holders.setdefault((host, line), set()).add((doc, text))
    return holders


def brute(rows, most_docs, least_left=0.3):
    holders = holders_of(rows)
    out = []
    for doc, text, host in rows:
        words = WORD.findall(text or "")
        grams = [tuple(words[i: i + 8]) for i in range(len(words) - 7)]
        hit = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(8)}
        own = [x for x in (text or "").split("\n") if WORD.search(x)]
        removed = sum(len(x.split(" ")) for x in lines(text) if len(holders[host, x]) > most_docs)
        failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
        kept = not failed and len(words) - removed >= least_left * len(words)
        out.append((doc, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
                    len(own) - len(set(own)), len(hit), failed, kept))
    return sorted(out, key=repr)


def corpus():
    unique = lambda i, n: " ".join(f"w{i}x{k}y" for k in range(n))
    rows = [(i, f"Menu  {i}: home\n{unique(chr(97 + i), 30)}\nmenu 7: HOME", "h1") for i in range(8)]
    rows += [(20 + i, "\n".join(["menu 1: home"] * 12 + [unique(chr(98 + i), 3)]), "h1") for i in range(2)]
    rows += [(30, "menu 1: home " * 8, "h2"), (31, unique("q", 25) + " " + unique("q", 25), None)]
    rows += [(32, unique("é#*", 40) + "\t\x0b\r\n\n \n" + unique("b", 3), None), (33, None, "h1"), (34, "", None)]
    rows += [(35, "a " * 50, "h1"), (None, unique("z", 21), "h1"), (36, unique("é", 22), "h1"), (36, unique("é", 22), "h1")]
    # Long menus that six documents of a host share, and little else: no window repeats.
    menus = "\n".join(f"{unique('m', 6)} {chr(112 + k)}{unique('n' + chr(112 + k), 8)}" for k in range(3))
    rows += [(60 + i, menus + "\n" + unique(f"own{chr(97 + i)}", 6), "h4") for i in range(6)]
    rows += [(37, " ".join(["one two three four five six seven eight"] * 2) + " " + unique("k", 60), "h3")]
    return rows


def test_matches_brute_force(spark):
    rows = corpus()
    docs = documents(spark, [(d, t, None, s) for d, t, s in rows])
    found = rows_of(rate_documents(docs, most_docs=4), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    "n_repeat_words", "base_failed", "kept")
    assert found == brute(rows, 4)
    assert any(not r[6] and not r[7] for r in found)  # the method rejects on its own


def test_texts_without_frequent_lines(spark):
    rows = corpus()
    holders = holders_of(rows)
    expected = []
    for doc, text, host in rows:
        own = (text or "").split("\n")
        left = [x for x in own if not normal(x) or len(holders[host, normal(x)]) <= 4]
        expected.append((doc, "\n".join(left), len(own), len(own) - len(left)))
    docs = documents(spark, [(d, t, None, s) for d, t, s in rows])
    found = rows_of(drop_frequent_lines(docs, most_docs=4), "doc_id", "text", "n_lines", "n_removed")
    assert found == sorted(expected, key=repr)
    assert sum(r[3] for r in found) > 30 and any(r[1] and r[3] for r in found)


def test_empty_table(spark):
    assert drop_frequent_lines(documents(spark, [])).collect() == []
    assert rate_documents(documents(spark, [])).collect() == []
