"""Piece-table middles against plain string slicing, and the way back from the output."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowscope.llm import fim

TEXTS = [None, "", "a", "two words", "ünï cödé 𝄞𝄞 text", "has <P> inside", "<S>", "x<M>", "<P", "<M <S> no", "line\nline\n" * 50,
         "日本語 " * 40000] + [f"document {i} of many words" * (i % 7 + 1) for i in range(150)]


def plain(doc_id, text):
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i: 8 * i + 8], 16) for i in range(4))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_rows_equal_string_slices(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id at all"), (-3, "negative"), (4, TEXTS[4])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(2) for c in ("n", "form", "output")})
    out = fim.fill_in_middle(docs).collect()
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = sorted((str(d), *plain(d, t or ""), sha(plain(d, t or "")[-1]), sha(t or "")) for d, t in rows)
    got = sorted((str(r.doc_id), r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.output_sha256, r.restored_sha256)
                 for r in out)
    assert str(got) == str(want)
    assert {r.form for r in out} == {"plain", "psm", "spm"}
    digest = {tuple(r) for r in fim.fim_digest(docs).collect()}
    assert digest == {tuple(r)[:-1] for r in out}
    assert fim.fim_digest(docs.limit(0)).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aé𝄞日<PSM> \n", max_size=60), st.integers(0, 60), st.integers(0, 60), st.sampled_from(["psm", "spm", "plain"]))
def test_pieces_round_trip(text, a, b, form):
    a, b = sorted((min(a, len(text)), min(b, len(text))))
    raw = text.encode()
    doc = fim.Pieces((memoryview(fim.SENTINELS), memoryview(raw)), [(1, 0, len(raw))])
    assert fim.byte_offsets(memoryview(raw), [a, b]) == [len(text[:a].encode()), len(text[:b].encode())]
    assert fim.code_points(memoryview(raw)) == len(text)
    if form != "plain" and any(m.decode() in text for m in fim.MARKS.values()):
        return
    out = fim.arrange(doc, form, fim.byte_offsets(memoryview(raw), [a, b]))
    assert out.sha256() == hashlib.sha256(out.tobytes()).hexdigest()
    back = fim.restore(out.tobytes(), form)
    assert back.tobytes() == raw and back.sha256() == hashlib.sha256(raw).hexdigest()
    # the output of a piece table can be cut again, across descriptors
    total = len(out.tobytes())
    parts = out.cut(sorted((total // 3, total // 2)))
    assert b"".join(p.tobytes() for p in parts) == out.tobytes()
