import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldloom.llm import line_dedup


def brute(rows):
    """Verdict of each line: equal to an earlier one, or within the bound of one, and the line that stays for it."""
    lines = sorted(((r.doc_id is None, r.doc_id or 0, no, line.split()) for r in rows for no, line in enumerate((r.text or "").encode().split(b"\n"))), key=lambda x: x[:3])
    seen, sizes, ends, out = {}, {}, {}, {}
    for none, doc, no, words in lines:
        at, joined = (None if none else doc, no), b" ".join(words).decode()
        if not words:
            out.setdefault(at, set()).add((None, at))
            continue
        if joined not in seen:
            seen[joined] = at
            near_sizes = [("w", len(words) + k) for k in (-1, 0, 1)] + (list(range(len(joined) + 2)) if len(words) < line_dedup.LONG else [])
            others = [x for k in near_sizes for x in sizes.get(k, [])]
            tied = [other for other, text in others if line_dedup.near(text, joined)]
            ends[at] = ends[min(tied, key=lambda a: (a[0] is None, a))] if tied else at
            sizes.setdefault(("w", len(words)), []).append((at, joined))
            if len(words) <= line_dedup.LONG:
                sizes.setdefault(len(joined), []).append((at, joined))
        head = seen[joined]
        out.setdefault(at, set()).add((None, at) if head == at == ends[at] else ("near" if head == at else "same", ends[head]))
    return out


def found(df):
    out = {}
    for r in line_dedup.verdicts(df).collect():
        assert r.kept == (r.reason is None)
        out.setdefault((r.doc_id, r.line_no), set()).add((r.reason, (r.keep_doc_id, r.keep_line_no)))
    return out


def test_verdicts(docs):
    out = found(docs)
    assert out == brute(docs.collect())
    stays = {at for at, v in out.items() if v == {(None, at)}}
    assert all(to in stays for v in out.values() for _, to in v)  # every pointer names a line that stays


def test_short_lines_and_borders(spark):
    """Lines under eight words by characters, pairs of seven and eight words by words, lines under eight characters not at all."""
    texts = ["All rights reserved.", "All rights reserved!", "All right reserved.", "abcdefg", "abcdefgh", "abcdefgX", "abcdeX", "one two", "onetwo",
             "a b c d e f g", "a b c d e f g h", "a b c d e f gg h", "a b c d e f g h i", "kurze Zeile ä", "kurze Zeile ö", "kurze  Zeile ä", "kurze Zeile äü"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    out = found(df)
    assert out == brute(df.collect())
    assert [out[i, 0] for i in (1, 2, 4, 5, 6, 8)] == [{("near", (0, 0))}] * 2 + [{("near", (3, 0))}] * 2 + [{(None, (6, 0))}, {(None, (8, 0))}]
    assert out[10, 0] == out[11, 0] == out[12, 0] == {("near", (9, 0))} and out[15, 0] == {("same", (13, 0))} and out[16, 0] == {("near", (13, 0))}


def test_odd_cases(odd, none):
    out = found(odd)
    assert out[1, 0] == {("same", (0, 0))} and out[2, 0] == {("same", (0, 0))} and out[0, 0] == {(None, (0, 0))}
    assert out[3, 0] == {("near", (0, 0))} and out[3, 1] == {("near", (0, 1))}
    assert out[12, 0] == {("near", (11, 0))}  # a long line with a word more
    assert out[4, 0] == {(None, (4, 0))} and out[5, 0] == {(None, (5, 0))}
    assert line_dedup.verdicts(none).count() == 0


def test_deduplicate(odd, none):
    out = line_dedup.deduplicate(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    texts = {r.doc_id: r.text for r in out.collect() if r.doc_id is not None}
    assert texts[1] == "" and texts[0] == odd.filter("doc_id = 0").first().text and texts[5] is None
    assert line_dedup.deduplicate(none).count() == 0


#: Words more than one character apart, so that short lines differ by more than the bound.
FAR = ["alpha", "bravo", "charlie", "delta", "echo", "foxtrot"]


def test_texts_that_share_an_id_lose_their_own_lines(spark):
    """A line that goes from one text stays in the others without doc_id or of the same doc_id."""
    again = "a line that stands in the first document and goes elsewhere"
    rows = [(1, again)] + [(doc_id, f"head {FAR[k]}\n{again if k % 2 else f'clean {FAR[k]}'}") for k in range(6) for doc_id in (None, 7)]
    df = spark.createDataFrame(rows[:1] + [(d, t.replace("head", f"head of {d}").replace("clean", f"clean of {d}")) for d, t in rows[1:]], "doc_id long, text string")
    out = {r.text for r in line_dedup.deduplicate(df).collect()}
    assert out == {again} | {f"head of {d} {FAR[k]}" + ("" if k % 2 else f"\nclean of {d} {FAR[k]}") for k in range(6) for d in (None, 7)}


def test_survivors_join_each_text_to_its_own_lines(spark):
    """Texts without doc_id bring their own lines alone, not those of all of them."""
    text = "{0} one two three four five six seven {0} nine ten eleven twelve"
    df = spark.createDataFrame([(None, text.format(f"w{k}")) for k in range(40)] + [(None, text.format(f"w{k}") + " more") for k in range(40)], "doc_id long, text string")
    assert line_dedup._verdicts(df).select("text_hash").distinct().count() == 80
    assert line_dedup.verdicts(df).filter("reason = 'near'").count() == 40


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abé", min_size=8, max_size=11), st.text(alphabet="abé", min_size=8, max_size=11))
def test_shared_character_keys_are_the_bound(a, b):
    wa, va = line_dedup.variants(a)
    wb, vb = line_dedup.variants(b)
    shared = any(x == y for x, y in zip(va, vb, strict=False)) and len(a) == len(b) or wa in vb or wb in va
    if a != b:
        assert bool(shared) == (distance(a, b) <= 1) == line_dedup.within_one(a, b)
        if shared:
            assert set(line_dedup._halves(a)) & set(line_dedup._halves(b))


words = st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=9)


@settings(max_examples=300, deadline=None)
@given(words, words)
def test_within_one(a, b):
    assert line_dedup.within_one(a, b) == (distance(a, b) <= 1)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), min_size=8, max_size=11), st.lists(st.sampled_from([b"a", b"b", b"c"]), min_size=8, max_size=11))
def test_shared_keys_are_the_bound(a, b):
    """Two different lines share a key and half of a line exactly if they are within one word."""
    wa, va = line_dedup.variants(a)
    wb, vb = line_dedup.variants(b)
    shared = any(x == y for x, y in zip(va, vb, strict=False)) and len(a) == len(b) or wa in vb or wb in va
    if a != b:
        assert bool(shared) == (distance(a, b) <= 1)
        if shared:
            assert set(line_dedup._halves(a)) & set(line_dedup._halves(b))


def test_many_variants_of_one_line(spark):
    """A template with many fillings: every one is tied to the earliest, none is lost."""
    template = "this template line has one word that changes {} and eight more words after it"
    rows = [(i, template.format(f"w{i}")) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: (r.reason, r.keep_doc_id) for r in line_dedup.verdicts(df).collect()}
    assert out == {0: (None, 0)} | {i: ("near", 0) for i in range(1, 300)}


pytestmark = pytest.mark.filterwarnings("ignore")
