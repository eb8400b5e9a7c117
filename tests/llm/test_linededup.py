"""Line and sentence dedup against a plain pass over the documents in order of their ids."""

from quillbar.llm import linededup

PASSAGE = ("This passage repeats across documents, word by word. It has several sentences, so that a paste in the middle of a line shows. "
           "Every sentence here is long enough to be a unit of its own. The last one closes the passage after fifty words or more, as planned.")
ROWS = [
    (3, "First line of three here ok\nsecond line is unique to three\n" + PASSAGE),
    (1, "Intro words before " + PASSAGE + " and some words after it\nshort line"),
    (2, "first  LINE of three HERE ok\nshort line\n\n \nlast words that nobody else has here"),
    (4, None), (5, ""), (6, "😀 one two three four five\n😀 one two three four five"), (None, "first line of three here ok"),
    (7, "\n".join(["the very same line again and again"] * 50)), (7, "the very same line again and again"),
]


def plain_tokens(line):
    """(start, stop, word in lower case, quarters of a word) of a line, character by character."""
    def quarters(c):
        if "\u3001" <= c <= "\u303f":
            return 0
        return 2 if "\u3040" <= c <= "\u9fff" else 1 if "\u0e00" <= c <= "\u0eff" else 4

    out, held = [], []
    for at, c in enumerate(line + " "):
        if held and (c.isspace() or quarters(c) < 4):
            out.append((held[0], at, line[held[0]:at].lower(), 4))
            held = []
        if not c.isspace():
            if quarters(c) < 4:
                out.append((at, at + 1, c, quarters(c)))
            else:
                held.append(at)
    return out


def plain_units(text):
    """(start, stop, key) with the words themselves as keys; only the places cut by content are asked of the operator."""
    by_content = {int(s) for s in linededup.units(text)[0]}
    out, at = [], 0
    for line in text.split("\n"):
        tokens = plain_tokens(line)
        size = sum(q for *_, q in tokens)
        cuts = [0] if tokens else []
        for k in range(1, len(tokens)):
            ends = tokens[k - 1][2][-1] in ".!?。！？｡" and tokens[k][3] > 0
            if size >= 32 and (ends or at + tokens[k][0] in by_content):
                cuts.append(k)
        pieces = list(zip(cuts, cuts[1:] + [len(tokens)]))
        weight = lambda a, b: sum(q for *_, q in tokens[a:b])
        for i, (a, b) in enumerate(pieces):
            onward = [e for _, e in pieces[i:] if weight(a, e) >= 32]
            back = [s for s, _ in pieces[:i + 1] if weight(s, b) >= 32]
            x, y = (a, onward[0]) if onward else (back[-1], b) if back else (0, len(tokens))
            if size >= 20:
                key = (tuple(t[2] for t in tokens[x:y]), a - x, b - a)
                out.append((at + tokens[a][0], at + tokens[b - 1][1], key))
        at += len(line) + 1
    return out


def expected(rows):
    first, out = {}, []
    for doc_id, text in rows:
        for _, _, key in plain_units(text or ""):
            if doc_id is not None:
                first[key] = min(doc_id, first.get(key, doc_id))
    for doc_id, text in rows:
        met, gone = set(), []
        for start, stop, key in plain_units(text or ""):
            if key in met or first.get(key, doc_id) != doc_id:
                gone.append((start, stop))
            met.add(key)
        joined = []
        for start, stop in gone:
            if joined and not text[joined[-1][1]:start].strip() and "\n" not in text[joined[-1][1]:start]:
                joined[-1] = (joined[-1][0], stop)
            else:
                joined.append((start, stop))
        out.append((doc_id, len(gone), joined))
    return sorted(out, key=str)


def words(text):
    return [t[2] for line in text.split("\n") for t in plain_tokens(line)]


def holds(stretch, unit):
    n = len(unit)
    return any(stretch[i] == unit[0] and stretch[i:i + n] == unit for i in range(len(stretch) - n + 1))


def test_every_removed_unit_stays_whole_in_its_first_document(spark):
    """On the given documents: units do not overlap, and what goes stands in a kept stretch of the document with the smallest id that has it."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    found = {r.doc_id: r for r in linededup.duplicates(docs).collect()}
    first = {}
    for doc_id in sorted(texts):
        starts, stops, _, d1, d2 = linededup.units(texts[doc_id])
        assert (starts[1:] >= stops[:-1]).all()
        for key in zip(d1.tolist(), d2.tolist()):
            first.setdefault(key, doc_id)
    kept = {d: [words(texts[d][s.start:s.stop]) for s in r.kept] for d, r in found.items()}
    checked = 0
    for doc_id, text in texts.items():
        start, stop, _, d1, d2 = linededup.units(text)
        gone = [(s.start, s.stop) for s in found[doc_id].removed]
        for a, b, key in zip(start.tolist(), stop.tolist(), zip(d1.tolist(), d2.tolist())):
            if any(x <= a and b <= y for x, y in gone):
                checked += 1
                assert any(holds(stretch, words(text[a:b])) for stretch in kept[first[key]]), (doc_id, text[a:b])
    assert checked > 50


def test_long_texts_are_cut_at_line_ends(spark, monkeypatch):
    text = "\n".join(f"line {i} has a few words of its own, and one more. Then a second sentence {i * 7919 % 1000} follows it here" for i in range(400))
    whole = linededup._units_of([text, "", text[:200]], 5, 8)
    monkeypatch.setattr(linededup, "STRETCH", 500)
    for a, b in zip(whole, linededup._units_of([text, "", text[:200]], 5, 8)):
        assert a.tolist() == b.tolist()
    long = " ".join(f"w{i}" for i in range(200_000))
    assert [g for _, g in zip(range(2), removed(spark, long, f"x {long}"))][0] == []


def test_matches_a_plain_pass(spark):
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string").repartition(3)
    got = sorted([(r.doc_id, r.n_removed, [(s.start, s.stop) for s in r.removed]) for r in linededup.duplicates(df).collect()], key=str)
    assert got == expected(ROWS)
    by_id = {r.doc_id: r.first_docs for r in linededup.duplicates(df).collect() if r.n_removed}
    assert by_id[3] == [1, 2] and by_id[None] == [2] and by_id[6] == [6]
    assert [g for g in got if g[0] == 1][0][1] == 0 and [g for g in got if g[0] == 3][0][1] >= 3


def test_spans_make_up_the_text_and_removal(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in ROWS], "doc_id bigint, text string, tag string")
    out = {(r.doc_id, r.text) for r in linededup.remove(df).collect()}
    assert (4, None) in out and (5, "") in out and (7, "the very same line again and again") in out
    assert ROWS[2] in out and any(t.startswith("\nsecond line is unique to three\n") for d, t in out if d == 3)
    for r in linededup.duplicates(df).collect():
        every = sorted([(s.start, s.stop) for s in [*r.removed, *r.kept]])
        assert all(a[1] == b[0] for a, b in zip(every, every[1:])) and (not every or every[0][0] == 0)


def removed(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(2)
    got = {r.doc_id: [texts[r.doc_id][s.start:s.stop] for s in r.removed] for r in linededup.duplicates(df).collect()}
    return [got[i] for i in range(len(texts))]


def test_short_sentences_count_with_their_neighbours(spark):
    passage = "It rained all day. Nobody came. We waited for hours! Then night fell? The long road home was dark and very quiet. So be it."
    first, second = f"One begins so. {passage} One ends", f"Another start of a line. {passage} Another end of it"
    assert removed(spark, first, second, "Nobody came. Others did. It rained all day.") == [[], [passage], []]
    # A line that ends in a blank, or is one run, is no repeat of its own sentence.
    assert removed(spark, "one two three four five six seven eight. ", "One two three four. Five six seven eight.") == [[], []]
    # The last of three is known by the two before it, which is the first such pair of its kind: the second alone repeats one that stays.
    assert removed(spark, "so it goes on. so it goes on. so it goes on.") == [["so it goes on."]]


def test_passages_inside_longer_sentences(spark):
    """No whole sentence repeats; all but the edges go, and nothing goes from the first document."""
    passage = " ".join(f"word{i * 7919 % 1000}" for i in range(80))
    around = [" ".join(f"{c}{i}" for i in range(12)) for c in "abcd"]
    first, second, third = removed(spark, f"{around[0]} {passage} {around[1]}.", f"Short one. {around[2]} {passage} {around[3]}", f"{passage[:40]} other words")
    gone = " ".join(second)
    assert first == third == [] and gone in passage and len(gone.split()) >= 40


def test_scripts_without_blanks(spark):
    chinese, thai = "今天天气很好我们一起去公园散步吧", "วันนี้อากาศดีมากเราไปเดินเล่นที่สวนสาธารณะกันเถอะ"
    got = removed(spark, f"{chinese}\n{thai}", f"甲乙。{chinese}。丙丁", f"{thai}\n你好", "你好")
    assert got[0] == got[3] == [] and got[2] == [thai]
    assert removed(spark, f"开始。{chinese}。结束", f"甲乙。{chinese}。丙丁") == [[], [f"{chinese}。"]]


def test_empty(spark):
    assert linededup.duplicates(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
