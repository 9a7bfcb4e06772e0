import numpy as np
from .plain import folded, prose

from stratum.llm import decontam as D


def plain_alignment(a, b):
    """Best local alignment score, cell by cell."""
    best, before = 0, [0] * (len(b) + 1)
    for x in a:
        now = [0]
        for j, y in enumerate(b):
            now.append(max(0, before[j] + (D.MATCH if x == y else D.MISMATCH), before[j + 1] + D.GAP, now[j] + D.GAP))
        best, before = max(best, max(now)), now
    return best


def test_alignment_equals_plain_recurrence():
    rng = np.random.default_rng(2)
    for _ in range(60):
        a = rng.integers(1, 6, rng.integers(1, 25)).astype(np.uint64)
        b = rng.integers(1, 6, (5, rng.integers(1, 60))).astype(np.uint64)
        score, start, stop = D.align(a, b)
        for k in range(5):
            assert score[k] == plain_alignment(a.tolist(), b[k].tolist())
            if score[k]:
                assert plain_alignment(a.tolist(), b[k][start[k]:stop[k]].tolist()) == score[k]


def edited(rng, text, every):
    """Words replaced, dropped and added in turn."""
    out = []
    for i, w in enumerate(text.split()):
        if i % every == every - 1:
            kind = (i // every) % 3
            out += [["other"], [], [w, "more"]][kind]
        else:
            out.append(w)
    return " ".join(out)


def cases():
    rng = np.random.default_rng(4)
    items = [(i, prose(rng, n, 900)) for i, n in enumerate((12, 25, 40, 60, 9))]
    docs = []
    for i, text in items:
        docs.append((100 + i, f"{prose(rng, 50)} {text} {prose(rng, 80)}", "en", "s"))
        docs.append((200 + i, f"{prose(rng, 10)} {edited(rng, text, 8)}", "en", "s"))
        docs.append((300 + i, text.upper().replace(" ", ", ") + ".", "en", "s"))
    clean = [(1000 + i, prose(rng, int(n)), "en", "s") for i, n in enumerate(rng.integers(1, 300, 150))]
    awkward = [(1, None, None, None), (2, "", "en", "s"), (3, items[2][1] * 1, "en", "s"), (3, items[2][1] * 1, "en", "s"), (None, items[1][1], "en", "s"),
               (4, (prose(rng, 20_000) + " " + items[3][1] + " ") * 2, "en", "s")]
    return items, docs, clean, awkward


def test_copies_are_found_and_clean_documents_left_alone(spark, documents):
    items, docs, clean, awkward = cases()
    bench = spark.createDataFrame([*items, (77, None), (78, "too short"), (79, "")], "item_id long, text string")
    rows = [*docs, *clean, *awkward]
    for block_words in (D.BLOCK_WORDS, 40):  # in one block, and in several
        got = D.contaminated(documents(rows), bench, block_words=block_words).collect()
        found = sorted((r.doc_id or -1, r.item_id) for r in got)
        want = [(100 * k + i, i) for k in (1, 2, 3) for i, _ in items] + [(3, 2), (3, 2), (-1, 1), (4, 3)]
        assert found == sorted(want)
        assert all(r.score == 1.0 for r in got if r.doc_id and r.doc_id // 100 in (1, 3))
    at = {r.doc_id: r for r in got}
    assert (at[102].from_word, at[102].to_word) == (50, 90)


def test_clean_drops_whole_documents(spark, documents):
    items, docs, clean, awkward = cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = documents([*docs, *clean, *awkward])
    kept = D.clean(frame, bench)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted([1, 2] + [c[0] for c in clean])
    empty = spark.createDataFrame([], "item_id long, text string")
    assert D.contaminated(frame, empty).count() == 0 and D.contaminated(frame.where("false"), bench).count() == 0


def test_clean_judges_rows_not_ids(spark, documents):
    """A clean row stays, whatever other rows share its id; in one block and in several."""
    rng = np.random.default_rng(14)
    items = [(i, prose(rng, 20, 900)) for i in range(6)]
    rows = [(1, items[0][1], "en", "s"), (1, prose(rng, 40, 900), "en", "s"), (2, prose(rng, 40, 900), "en", "s"), (None, items[3][1], "en", "s"),
            (None, prose(rng, 30, 900), "en", "s"), (None, None, None, None), (3, "x " + items[5][1], "en", "s"), (3, "", "en", "s"), (3, "", "en", "s")]
    frame = documents(rows)
    for block_words in (D.BLOCK_WORDS, 40):
        kept = D.clean(frame, spark.createDataFrame(items, "item_id long, text string"), block_words=block_words)
        assert kept.columns == frame.columns
        key = lambda r: (str(r[0]), str(r[1]))
        assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=key) == sorted(((r[0], r[1]) for i, r in enumerate(rows) if i not in (0, 3, 6)), key=key)


def test_a_copy_in_every_document_is_still_seeded(spark, documents):
    """Seeds are rare by comparison, not by a limit: an item that a third of all rows copy is found in each."""
    rng = np.random.default_rng(8)
    item = prose(rng, 30)
    rows = [(i, f"{prose(rng, 20)} {item if i % 3 == 0 else ''} {prose(rng, 20)}", "en", "s") for i in range(300)]
    got = D.contaminated(documents(rows), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert sorted(r.doc_id for r in got) == list(range(0, 300, 3))


def plain_found(docs, items, need):
    """Every document against every item, cell by cell."""
    return sorted((d, i) for d, t, *_ in docs for i, x in items
                  if plain_alignment(folded(x), folded(t)) >= need(len(folded(x))))


def test_copies_without_long_unedited_runs_equal_brute_force(spark, documents):
    """Words replaced at every 3rd to 6th place or at random, and words added: no copy at the threshold is lost."""
    rng = np.random.default_rng(12)
    items = [(i, prose(rng, n, 900)) for i, n in enumerate((15, 20, 25, 38, 59))]
    docs = [(9000 + i, prose(rng, int(n), 900), "en", "s") for i, n in enumerate(rng.integers(1, 120, 20))]
    for i, text in items:
        plain = text.split()
        copies = [[f"x{k}" if k % every == every - 1 else w for k, w in enumerate(plain)] for every in (3, 4, 5, 6)]
        copies += [[f"x{k}" if rng.random() < 0.2 else w for k, w in enumerate(plain)] for _ in range(8)]
        copies += [[x for k, w in enumerate(plain) for x in ([w, f"y{k}"] if k % every == 0 else [w])] for every in (1, 2, 3)]
        copies += [[w for k, w in enumerate(plain) if k % 3]]
        docs += [(100 * i + k, " ".join([prose(rng, 10), *c, prose(rng, 10)]), "en", "s") for k, c in enumerate(copies)]
    want = plain_found(docs, items, lambda n: D.MATCH * min(D.RATIO * n, D.ENOUGH))
    assert len(want) > 60
    got = D.contaminated(documents(docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == want
    text = dict((d, t) for d, t, *_ in docs)
    for r in got:
        full = plain_alignment(folded(dict(items)[r.item_id]), folded(text[r.doc_id]))
        assert r.score == min(1.0, full / (D.MATCH * min(len(folded(dict(items)[r.item_id])), D.ENOUGH / D.RATIO)))


def test_short_items_and_texts_without_spaces(spark, documents):
    rng = np.random.default_rng(3)
    zh = "人工智能正在改變我們的生活方式和工作方法未來會怎樣"
    th = "กรุงเทพมหานครเป็นเมืองหลวงของประเทศไทย"
    items = [(1, "What is the capital of France?"), (2, "one two three"), (3, "Xylophone"), (4, zh), (5, th), (6, "機械学習とは何ですか"),
             (7, "a1 a2 a3 a4 a5 a6 a7 a8 a9 a10")]
    edited_zh = "".join("誰" if i % 6 == 5 else c for i, c in enumerate(zh))
    docs = [(10, "Paris is the capital of France and more"), (11, "He said: what is the Capital of France, then left"),
            (20, "one two and three"), (21, "so one, two, THREE it is"), (30, "a xylophone plays"), (31, "xylophones play"),
            (40, f"他說{zh}。謝謝"), (41, f"他說,{edited_zh}謝謝"), (42, "我們的生活很好,工作方法也不錯"), (50, f"สวัสดี{th}ครับ"), (51, "ประเทศไทยสวยงาม"),
            (60, "質問:「機械学習とは何ですか」。"), (61, "機械学習とは何でしょう"), (70, "a1 a2 a3 a4 a5 b"), (71, "x a2 a3 a4 a5 a6 a7 a8 y")]
    rows = [(i, t, "en", "s") for i, t in docs] + [(1000 + i, prose(rng, 50), "en", "s") for i in range(20)]
    got = D.contaminated(documents(rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(11, 1), (21, 2), (30, 3), (40, 4), (41, 4), (50, 5), (60, 6), (71, 7)]
    assert all(r.score == 1.0 for r in got if r.doc_id not in (41, 71))
    assert D.contaminated(documents(rows), spark.createDataFrame(items, "item_id long, text string"), min_words=8).count() == 5
