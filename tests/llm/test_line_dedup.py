import collections
import hashlib

from innspark.llm.line_dedup import drop_repeated_lines, op7_line_dedup


def brute(rows, least=10):
    def key(line):
        line = line.strip(" \t\n\x0b\x0c\r")
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line)

    homes = collections.defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if doc is not None and len(key(line)) >= least:
                homes[key(line)].add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc is None or len(homes.get(key(x), ())) < 2
                or doc == min(homes[key(x)])]
        out.append((doc, len(lines), len(lines) - len(kept),
                    hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def check(docs_of, rows):
    got = [tuple(r) for r in op7_line_dedup(docs_of(rows)).collect()]
    assert sorted(got, key=str) == brute([r[:2] for r in rows])


def test_lines(docs_of):
    many = "\n".join(f"line number {k}" for k in range(200))
    check(docs_of, [
        (1, "Shared line here\nown line of one\nshort"), (2, "  shared LINE here\t\nshort\n\n"),
        (3, "SHARED line here\nSHARED line here\nÉTÉ commence ici\n"), (4, "été commence ici\nétÉ commence ici"),
        (5, many), (6, many + "\nand its own end"), (7, "exactly 10"), (8, "exactly 10\r"), (9, "nine char"),
        (10, "nine char")])


def test_odd_rows(docs_of, odd_rows):
    check(docs_of, odd_rows)


def test_empty(docs_of):
    assert drop_repeated_lines(docs_of([])).count() == 0
