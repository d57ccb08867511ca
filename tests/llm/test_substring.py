"""Substring deduplication against brute force."""

from odoscore.llm import substring_dedup as D

DOCS = "doc_id long, text string, n_removed string"


def test_sentences_cover_the_text():
    for text in ("", " ", "One. Two!  Three?\nFour", "word " * 500, "a.b c. \n\n d", "No end"):
        pieces = D.sentences(text)
        assert "".join(text[s:e] for s, e, _, _ in pieces) == text
        assert sum(p[3] for p in pieces) == len(text.split())


def test_spans_are_the_shortest_runs():
    text = "One two three. Four five six seven. Eight nine ten eleven twelve thirteen. Alone."
    found = D.spans(D.sentences(text))
    assert [(first, n) for first, n, _ in found] == [(0, 3)]


def slow(rows):
    spans = {(i, t): D.spans(D.sentences(t or "")) for i, t, _ in rows}
    owner = {}
    for (i, _), found in spans.items():
        for _, _, h in found:
            if i is not None:
                owner[h] = min(owner.get(h, i), i)
    out = {}
    for (i, t), found in spans.items():
        gone, seen = set(), set()
        for first, n, h in found:
            if h in seen or (h in owner and (i is None or owner[h] < i)):
                gone |= set(range(first, first + n))
            seen.add(h)
        out[i, t] = "".join((t or "")[s:e] for k, (s, e, _, _) in enumerate(D.sentences(t or "")) if k not in gone) if gone else t
    return sorted((str(i), str(out[i, t])) for i, t, _ in rows)


def sentence(seed, n=9):
    return " ".join(f"w{(seed * 31 + j * 7) % 997}" for j in range(n)) + ". "


def test_documents(spark):
    passage = "".join(sentence(s) for s in (1, 2, 3, 4, 5, 6))
    rows = [(i, sentence(50 + i) + passage + sentence(90 + i), "x") for i in range(12)]
    rows += [(30, sentence(70) * 5, "x"), (31, sentence(71), "x"), (32, None, "x"), (33, "", "x"), (None, passage, "x"), (None, passage, "x"), rows[3]]
    rows += [(40, sentence(1) + sentence(200), "x"), (41, "x y z " * 30_000, "x"), (42, passage.upper().replace(" ", "  "), "x"), (4, sentence(300) + sentence(301), "x")]
    frame = spark.createDataFrame(rows, DOCS)
    out = D.substring_dedup(frame, keep_text=True)
    assert out.columns == ["doc_id", "text", *D.ADDED]
    got = out.collect()
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in got) == slow(rows)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[0]["n_removed"] == 0 and by_id[0]["first_doc_ids"] is None
    assert by_id[7]["first_doc_ids"] == [0] and by_id[7]["n_removed"] == 6
    for r in got:
        source = next(t for i, t, _ in rows if i == r["doc_id"] and (t or "").startswith((r["text"] or "")[:5]))
        kept, at = "", 0
        for s, e in r["removed_spans"]:
            kept, at = kept + source[at:s], e
        assert kept + (source or "")[at:] == (r["text"] or "")


def test_nothing(spark):
    assert D.substring_dedup(spark.createDataFrame([], DOCS)).count() == 0


def brute(texts):
    """Text left of each document if every repeated long enough run is removed, all runs compared."""
    owner, out = {}, []
    for text in texts:
        pieces = D.sentences(text)
        gone, own = set(), {}
        for i in range(len(pieces)):
            for j in range(i + D.LEAST_SENTENCES, len(pieces) + 1):
                if sum(p[3] for p in pieces[i:j]) >= D.LEAST_WORDS:
                    key = tuple(p[2] for p in pieces[i:j])
                    if key in owner or own.setdefault(key, i) < i:
                        gone |= set(range(i, j))
        for key in own:
            owner.setdefault(key, True)
        out.append("".join(text[s:e] for k, (s, e, _, _) in enumerate(pieces) if k not in gone))
    return out


def test_every_repeated_run_is_removed_whole(spark):
    import random

    random.seed(3)
    pool = [" ".join(f"v{k}x{j}" for j in range(random.randint(1, 9))) + ". " for k in range(40)]
    texts = ["A b c d e f g. H i j k l m n. O p. Only here one. ", "Before this. A b c d e f g. H i j k l m n. O p. After it. "]
    for _ in range(60):
        at = random.randrange(36)
        texts.append("".join([*random.choices(pool, k=2), *pool[at: at + random.randint(2, 6)], *random.choices(pool, k=3)]))
    texts += texts[5:8]
    want = brute(texts)
    assert want[1] == "Before this. After it. " and want[-1] == ""
    rows = D.substring_dedup(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string"), keep_text=True).collect()
    assert [r["text"] for r in sorted(rows, key=lambda r: r["doc_id"])] == want
