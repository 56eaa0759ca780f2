"""Documents with everything an operator must bear, and brute-force helpers."""

import re
from collections import defaultdict

SCHEMA = """doc_id bigint, text string, lang string, source string, n_chars bigint, score string,
kept string, row string, kept_id string, rid string, node string, id string, n string, h string, s string, bucket string,
block string, label string, key string, found string, words string, lines string, slot string, features string"""
ENGLISH = "the quick brown fox jumps over the lazy dog while seven other animals watch from behind the old stone wall near the river"
GERMAN = "der schnelle braune fuchs springt über den faulen hund während sieben andere tiere hinter der alten mauer am fluss zusehen"
LONG = " ".join(f"word{i % 977}x{i % 131}" for i in range(30_000))


def odd_rows():
    near = ENGLISH.split() * 1
    texts = [
        (1, ENGLISH + " with a few more words in the first copy of it", "en", "a"),
        (2, ENGLISH + " with a few more words in the first copy of it", "en", "a"),
        (2, ENGLISH + " with a few more words in the first copy of it", "en", "a"),
        (3, ENGLISH.replace(" ", "\n ") + " with a few more words in the first copy of it", "en", None),
        (4, GERMAN, "de", "b"),
        (5, GERMAN.upper() + "!!!", "de", "b"),
        (6, None, None, None),
        (7, "", "en", "b"),
        (8, " \t\n\r\v\f ", None, "b"),
        (9, "123 456 --- $$$", "en", "c"),
        (10, LONG, "en", "c"),
        (11, LONG + " end", "en", "c"),
        (None, "a row without an id but with some words in it", "en", "a"),
        (None, "a row without an id but with some words in it", "en", "a"),
        (12, "one", "en", "a"),
        (13, "ONE", "en", "a"),
        (14, "one two three", None, "a"),
        (15, " ".join(near * 6), "en", "a"),
        (16, "\U0001F600 emoji été İstanbul K " + ENGLISH, "en", "a"),
        (17, "line one\nline one\nline two\n\nline one", "en", "a"),
    ]
    extra = ("x",) * 19
    return [(i, t, lang, source, None if t is None else len(t), *extra) for i, t, lang, source in texts]


def odd_documents(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def ascii_lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def space_words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def shingle_set(text, size=4):
    words = space_words(ascii_lower(text or ""))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(size))))


def jaccard_components(texts, percent=85):
    """Component number (smallest index) of every text, by comparing all pairs that share anything."""
    sets = [shingle_set(t) for t in texts]
    where = defaultdict(list)
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, own in enumerate(sets):
        shared = defaultdict(int)
        for x in own:
            for j in where[x]:
                shared[j] += 1
            where[x].append(i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(own) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))], [len(s) for s in sets]
