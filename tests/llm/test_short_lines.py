"""Equal lines go whatever their length; short lines an edit apart stay, and so do blank ones."""

from __future__ import annotations

from slipstream.llm import lines

WHITE = " \t\r\x0b\x0c"


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b))) if len(b) == len(a) + 1 else False


def by_brute_force(texts: list[str]) -> list[tuple[str, int, int]]:
    seen, out = set(), []
    for text in texts:
        split, kept = text.split("\n"), []
        for raw in split:
            line = raw.strip(WHITE)
            near = len(line) >= lines.LEAST and any(len(x) >= lines.LEAST and one_edit(x, line) for x in seen)
            if not line or not (line in seen or near):
                kept.append(raw)
            if line:
                seen.add(line)
        out.append(("\n".join(kept), len(split), len(split) - len(kept)))
    return out


def test_short_lines(spark):
    texts = [
        "Les.\nfirst document here\nDie.", "Les.\nanother text of it\nDel.", "  Les. \t\nthird of them\n\n \t",
        "x\nx\ny\n\n\n", "x\n\nxy\nabc", "123456789012345\n1234567890123456\nfirst document herf",
        "123456789012345\n12345678901234\n1234567890123457\n123456789012346", "é\nÉ\né", "",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = lines.deduplicate(docs).orderBy("doc_id").collect()
    want = by_brute_force(texts)
    assert [(r.text, r.n_lines, r.n_removed) for r in got] == want
    assert want[1][0] == "another text of it\nDel." and want[2][0] == "third of them\n\n \t"


def test_short_repeats_of_given_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    texts = [r.text for r in lines.deduplicate(docs).collect() if r.text is not None]
    left = [x.strip(WHITE) for t in texts for x in t.split("\n") if x.strip(WHITE)]
    assert len(left) == len(set(left))
