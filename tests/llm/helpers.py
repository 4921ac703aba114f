"""Odd tables that every operator has to stand, and plain versions of common steps."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long, k_id string, runs int, name string"


def documents(spark, rows, parts=3):
    """Documents of (doc_id, text[, lang[, source]]), with extra columns of clashing names."""
    full = [(*r, *[None] * (4 - len(r)), 0, "x", 1, "y") for r in rows]
    return spark.createDataFrame(full, DOCS).repartition(parts)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def edit_distance(one, two):
    before = list(range(len(two) + 1))
    for i, a in enumerate(one, 1):
        now = [i]
        for j, b in enumerate(two, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (a != b)))
        before = now
    return before[-1]


def classes_of(items, linked):
    """Smallest member of the connected class of every item, all pairs looked at."""
    root = {i: i for i in items}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in items:
        for j in items:
            if i < j and linked(i, j):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in items}
