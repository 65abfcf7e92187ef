from conftest import rows
from llm_data import frame, prose  # noqa: F401

from lakemodels.llm import decontamination as D

ITEM = (
    "A train leaves the old station at 40 km/h while Alice walks 12 minutes along the river before she meets the "
    "conductor near the bridge and pays 7 dollars for both tickets"
)


def found(spark, frame, texts, items=(ITEM,), **settings):
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = D.contaminated(frame(list(enumerate(texts))), benchmark, **settings).select("doc_id", "item_id", "exact")
    return sorted(map(tuple, got.collect()))


def test_copies_and_changed_questions_are_found(spark, frame):
    other = ITEM.replace("40", "65").replace("12", "9").replace("Alice", "Robert").replace("7 dollars", "11 dollars")
    texts = [
        prose(1, 30) + " " + ITEM + " " + prose(2, 30),
        other,
        ITEM.upper(),
        ITEM.lower().replace(" ", "\n"),
        prose(4, 80),
        " ".join(ITEM.split()[:11]),
    ]
    assert found(spark, frame, texts) == [(0, 0, True), (1, 0, False), (2, 0, True), (3, 0, True)]


def test_slots_must_fit(spark, frame):
    item = "First take 5 apples from the basket then add 5 pears to it and count how many fruits of both kinds are there"
    fits, differs = item.replace("5", "8"), item.replace("5 apples", "8 apples")
    assert found(spark, frame, [fits, differs], [item], least_share=1.0, enough_words=99) == [(0, 0, False)]


def test_short_items_match_as_a_whole(spark, frame):
    assert found(spark, frame, ["so what is seven times eight in base ten then", "what is seven"], ["what is seven times eight"]) == [(0, 0, True)]


def test_items_of_mostly_numbers_match_verbatim_only(spark, frame):
    items = ["3 5 8 13 21 34 55 89 what comes next", "12 + 30 = 42 7 * 6 = 42 9 km 8 kg 100 - 58"]
    texts = [prose(1, 30) + " " + items[0] + " " + prose(2, 30), items[1], items[0].replace("13", "14"), "3 5 8 13"]
    assert found(spark, frame, texts, items, least_share=1.0, enough_words=99) == [(0, 0, True), (1, 1, True)]


def test_half_of_a_short_item_is_found_around_a_change(spark, frame):
    items = ["why does warm air rise above cold air over the whole wide ocean", prose(61, 15), prose(62, 20)]
    words = [item.split() for item in items]
    texts = [
        " ".join([*words[0][:6], "hot", *words[0][7:]]),
        prose(63, 20) + " " + " ".join(words[1][4:12]) + " " + prose(64, 20),
        " ".join([*words[2][:10], "added", *words[2][10:]]),
        " ".join(words[1][4:11]),
    ]
    assert found(spark, frame, texts, items) == [(0, 0, True), (1, 1, True), (2, 2, True)]


def test_items_with_several_changed_words_are_found(spark, frame):
    items = [prose(71, 20), prose(72, 30), prose(73, 30)]
    words = [item.split() for item in items]
    two = [w if k not in (6, 13) else "changed" for k, w in enumerate(words[0])]
    many = [w if k % 6 else "changed" for k, w in enumerate(words[1])]
    apart = [w if k % 5 else "changed" for k, w in enumerate(words[2])]  # no five words in a row are left
    assert found(spark, frame, [" ".join(two), " ".join(many), " ".join(apart)], items) == [(0, 0, True), (1, 1, True)]


def test_filtered_windows_are_those_of_a_plain_search():
    """All windows of a text that an item has, in every reading, against windows made one size at a time."""
    import random

    import numpy as np

    draw, known = random.Random(3), D.TemplateWords()
    vocabulary = "the cat sat on a mat with Bob and Ann for 3 or 12 km near 5 of 7 in it".split()
    sentence = lambda n: " ".join(draw.choice(vocabulary) for _ in range(n))
    written = [sentence(draw.randrange(5, 30)) for _ in range(40)]
    items = [D.Template(known, item) for item in written]
    sizes = [5, 7, 9, 12]

    def bloom(values):
        out = np.zeros(1 << 14, np.int64)
        for by in D.in_bloom.__globals__["_BLOOM_SHIFTS"]:
            bit = (values >> by) % (64 * len(out))
            np.bitwise_or.at(out, bit >> 6, np.int64(1) << (bit & 63))
        return out

    held = {(size, h) for item in items for size in sizes for h in item.windows(size)[0].tolist()}
    runs = bloom(np.concatenate([item.runs(5) for item in items]))
    windows = bloom(np.array([h for _, h in held]))
    met = 0
    for _ in range(200):
        part = draw.choice(written).split()[draw.randrange(4) :][: draw.randrange(4, 30)]
        text = D.Template(known, " ".join([sentence(draw.randrange(20)), *part, sentence(draw.randrange(20))]))
        wanted = {(s, h, p, t) for s in sizes for h, p, t in zip(*(c.tolist() for c in text.windows(s))) if (s, h) in held}
        got = text.found(sizes, 5, runs, windows)
        assert len(got) == len(set(got)) and wanted <= set(got)
        met += len(wanted)
    assert met > 100


def test_no_window_is_lost_by_the_filter(spark, frame):
    """Against a plain search for all runs of twelve words."""
    items = [prose(s, 40) for s in range(20)]
    texts = [prose(900 + k, 50) + " " + " ".join(items[k % 20].split()[k % 5 : k % 5 + 25]) for k in range(60)]
    texts += [prose(5000 + k, 70) for k in range(40)]
    wanted = []
    for d, text in enumerate(texts):
        for i, item in enumerate(items):
            words = item.split()
            if any(" ".join(words[k : k + 20]) in text for k in range(len(words) - 19)):
                wanted.append((d, i, True))
    assert found(spark, frame, texts, items) == wanted


def test_rows_that_are_odd(spark, frame):
    benchmark = spark.createDataFrame([(1, ITEM), (1, ITEM), (None, ITEM), (2, None), (3, ""), (4, "1 2 3 4 5 6 7")], "item_id long, text string")
    df = frame([(1, ITEM), (1, ITEM), (None, ITEM), (2, None), (3, ""), (4, (ITEM + " ") * 3000)], ["item_id", "hash"])
    assert rows(D.contaminated(df, benchmark).select("doc_id", "item_id")) == [(1, 1), (4, 1)]
    assert D.contaminated(frame([]), benchmark).count() == 0
    assert D.contaminated(df, benchmark.limit(0)).count() == 0
