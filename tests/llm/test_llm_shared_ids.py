"""Rows that share an id: each text is judged on its own."""

import pytest

from parcelspark.llm import substring_dedup
from parcelspark.llm.substring_dedup import Settings


def brute(rows, size=20):
    """Kept words per row; texts of one id differ, so windows are ordered by (id, text, start) with any order of the texts."""
    first = {}
    for doc_id, text in rows:
        words = (text or "").split()
        for i in range(len(words) - size + 1):
            w = tuple(words[i:i + size])
            first[w] = min(first.get(w, (doc_id, i)), (doc_id, i))
    out = []
    for doc_id, text in rows:
        words = (text or "").split()
        gone = {i + k for i in range(len(words) - size + 1) if first[tuple(words[i:i + size])] != (doc_id, i) for k in range(size)}
        out.append((doc_id, " ".join(x for i, x in enumerate(words) if i not in gone)))
    return sorted(out)


def words(tag, n):
    return " ".join(f"{tag}{i}" for i in range(n))


@pytest.mark.parametrize("settings", [Settings(), Settings(copies_from=1, group_rows=20_000), Settings(copies_from=1, group_rows=1)])
def test_no_text_is_lost_to_a_shared_id(spark, settings):
    w, u, v = words("w", 30), words("u", 30), words("v", 45)
    rows = [(1, w), (5, w), (5, u), (5, u), (7, v), (7, f"{u} {words('x', 25)}"), (8, f"{words('y', 4)} {v}"), (8, None), (8, ""),
            (9, f"{words('w', 25)} end"), (9, words("z", 19))]
    done = substring_dedup.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string"), settings).collect()
    assert sorted((r.doc_id, bytes(r.kept).decode()) for r in done) == brute(rows)
    # one long passage in two texts of one id: one of them keeps it
    rows = [(3, f"{w} a"), (3, f"b {w}"), (4, u)]
    kept = sorted(bytes(r.kept).decode() for r in
                  substring_dedup.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string"), settings).collect())
    assert kept in (sorted([f"{w} a", "b", u]), sorted(["a", f"b {w}", u]))
