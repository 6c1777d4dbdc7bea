import hashlib
import random
import re

from ledgerline.llm import decontam
from .conftest import LONG, ROWS, documents

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return _WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def slow(rows, items, window=10):
    places = {}
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            places.setdefault(tuple(w[k:k + window]), set()).add(str(item))
    out = []
    for i, text in rows:
        w, hit, found = words(text), set(), set()
        for n in {len(p) for p in places}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in places:
                    hit |= set(range(k, k + n))
                    found |= places[tuple(w[k:k + n])]
        out.append((i or -1, len(w), len(hit), len(found),
                    hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def fast(docs, spark, items, **options):
    bench = spark.createDataFrame(items, "item_id long, text string")
    return sorted((r["doc_id"] or -1, *list(r)[2:]) for r in
                  decontam.judge(docs, bench, **options).collect())


ITEMS = [(1, "the quick brown fox jumps over the lazy dog again and again"), (2, None), (3, " .,; "),
         (4, "one"), (5, "NAÏVE café"), (6, " ".join(LONG.split()[5000:5400])), (7, "a b c"),
         (8, "the quick brown fox jumps over the lazy dog again and again"), (10, "一 二")]


def test_edge_rows_and_short_items(spark, docs):
    assert fast(docs, spark, ITEMS) == slow(ROWS, ITEMS)


def test_random_texts_over_few_words(spark):
    r = random.Random(3)
    vocabulary = "a b c d é".split()
    text = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    items = [(k, text(r.choice([0, 1, 2, 3, 4, 5, 9]))) for k in range(6)]
    rows = [(i, text(r.randrange(40))) for i in range(60)]
    rows += [(100 + i, text(5) + " " + items[5][1] + "! " + text(90)) for i in range(5)]
    assert fast(documents(spark, rows), spark, items, window=4) == slow(rows, items, 4)


def test_a_word_does_not_reach_into_the_next_text(spark):
    rows = [(1, "alpha bet"), (2, "a gamma"), (3, "alpha beta")]
    assert fast(documents(spark, rows), spark, [(1, "beta"), (2, "bet a")]) == \
        slow(rows, [(1, "beta"), (2, "bet a")])


def test_drop_keeps_clean_rows_and_columns(spark, docs):
    bench = spark.createDataFrame(ITEMS[:1], "item_id long, text string")
    kept = decontam.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert kept.count() == len(ROWS) - 1 and kept.filter("doc_id = 1").isEmpty()


def test_empty_tables(spark, docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.judge(docs, none).filter("contaminated").count() == 0
    assert decontam.judge(docs, none).count() == len(ROWS)
    assert decontam.judge(no_docs, spark.createDataFrame(ITEMS, none.schema)).count() == 0
