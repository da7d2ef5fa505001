import random
from collections import defaultdict

from almanac.llm.lines import DEPTH, FIXED, LEAST_DOCS, LEAST_TOKENS, VARIABLE, drop_recurring_lines
from tests.conftest import rows

SCHEMA = "doc_id long, text string"


def masked(line):
    return " ".join(VARIABLE if any(c in "0123456789" for c in t) else t for t in line.split(" "))


def expected(docs):
    def leaf(line):
        tokens = masked(line).split(" ")
        return len(tokens), " ".join(tokens[:DEPTH])

    def most(kinds):
        return len(kinds) >= LEAST_DOCS

    leaves, line_kinds = defaultdict(set), defaultdict(set)
    for _, text in docs:
        if text is not None:
            for x in text.split("\n"):
                if leaf(x)[0] >= LEAST_TOKENS:
                    leaves[leaf(x)].add(text)
                    line_kinds[masked(x)].add(text)
    tokens = defaultdict(set)
    for x, kinds in line_kinds.items():
        at = leaf(x)
        for pos, t in enumerate(x.split(" ")):
            if most(leaves[at]):
                tokens[at, pos, t] |= kinds
    shapes, templates = {}, defaultdict(set)
    for x, kinds in line_kinds.items():
        at = leaf(x)
        shape = [t if t != VARIABLE and most(tokens[at, pos, t]) else None for pos, t in enumerate(x.split(" "))]
        if sum(t is not None for t in shape) * 100 >= FIXED * len(shape):
            shapes[x] = (at, tuple(shape))
            templates[shapes[x]] |= kinds
    gone = {x for x, shape in shapes.items() if most(templates[shape])}
    out = []
    for doc_id, text in docs:
        lines = [] if text is None else text.split("\n")
        left = [x for x in lines if masked(x) not in gone]
        out.append((doc_id, None if text is None else "\n".join(left), len(lines), len(lines) - len(left)))
    return sorted(out, key=lambda r: tuple((v is not None, v) for v in r))


def check(spark, docs):
    found = drop_recurring_lines(spark.createDataFrame(docs, SCHEMA))
    found = rows(found.selectExpr("doc.doc_id", "text", "n_lines", "n_dropped"))
    assert found == expected(docs)
    return found


def corpus(seed):
    rng = random.Random(seed)
    docs = []
    for d in range(120):
        lines = [" ".join(rng.choice("abcdefgh") + str(rng.choice(["", "", "", 7])) for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(5))]
        lines.append(" ".join(f"own{rng.choice('pqrstuvw')}{chr(97 + d % 26)}{chr(97 + d // 26)}" for _ in range(20)))
        if d % 3 == 0:
            lines.append(f"page {rng.randrange(99)} of the report by {rng.choice(['ann', 'bob'])} printed here today")
        if d % 4 == 0:
            lines.insert(0, f"please share this with {rng.choice('uvwxyz') * 3} if you like it at all")
        docs.append((d, "\n".join(lines)))
    return docs


def test_against_brute_force(spark):
    found = check(spark, corpus(1))
    assert sum(r[3] for r in found) > 50
    check(spark, corpus(2))


def test_templates_go_with_what_varies_in_them(spark):
    names = ["ann", "bob", "cyd", "dan", "eve", "fay", "gus"]
    docs = [(i, f"unique {n} line {n * 3} of {n}\nthis mail was sent to {n} by our list") for i, n in enumerate(names)]
    found = check(spark, docs)
    assert all(r[3] == 1 and "mail" not in r[1] for r in found)


def test_copies_keep_their_lines(spark):
    docs = [(i, "one long line of a document that was copied\nand its second line here") for i in range(50)]
    assert all(r[3] == 0 for r in check(spark, docs))


def test_odd_rows(spark):
    docs = [(i, "a b c\n\n\n") for i in range(3)] + [(9, None), (10, ""), (None, "x y z"), (None, "x y z"), (11, "w " * 100_000), (12, "\n")]
    check(spark, docs)
    clash = spark.createDataFrame([(1, "a b c")], SCHEMA).selectExpr("*", "1 as k", "2 as lines", "3 as gone", "4 as kind", "5 as doc")
    assert drop_recurring_lines(clash).selectExpr("doc.*").columns == clash.columns
    assert rows(drop_recurring_lines(spark.createDataFrame([], SCHEMA))) == []


def test_boilerplate_longer_than_own_lines_goes_by_copies(spark):
    rng = random.Random(3)

    def own(n):
        return " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))

    head, foot = "all rights to this page are held by those who wrote it long ago", "see the other pages of this site for more of what you looked for"
    kinds = {
        "framed": [f"{head}\n{own(8)}\n{own(9)}\n{foot}" for _ in range(8)],
        "doubled": [f"we sent this page to you once more\n{own(5)}\n{own(5)}\nwe sent this page to you once more" for _ in range(8)],
        "single": [f"your order was sent out today {own(1)} to {own(1)}" for _ in range(8)],
    }
    same = "\n".join(own(30) for _ in range(4))
    docs = [(i, t) for i, t in enumerate([*kinds["framed"], *kinds["doubled"], *kinds["single"], *[f"{same}\n{own(3)}" for _ in range(8)]])]
    found = drop_recurring_lines(spark.createDataFrame(docs, SCHEMA), by_copies=True)
    dropped = {r[0]: r[1] for r in rows(found.selectExpr("doc.doc_id", "n_dropped"))}
    assert [dropped[i] for i in range(32)] == [2] * 16 + [1] * 8 + [0] * 8


def test_every_recurring_template_goes(spark):
    header = " ".join(f"head{chr(97 + i)}" for i in range(25))
    footer = " ".join(f"foot{chr(97 + i)}" for i in range(25))
    letters = [chr(97 + i % 26) + chr(97 + i // 26) for i in range(300)]
    docs = [(i, f"{header}\nown{x} words{x} here{x}\n{footer}") for i, x in enumerate(letters)]
    docs += [(1000 + i, f"page {i} of {x} was not found on this server today") for i, x in enumerate(letters)]
    docs += [(2000 + i, f"{header} twice\n{x} x{x} y{x}\n{header} twice") for i, x in enumerate(letters)]
    found = check(spark, docs)
    assert [sum(r[3] for r in found if r[0] // 1000 == k) for k in range(3)] == [600, 300, 600]


def test_what_near_copies_share_goes_from_the_fifth_on(spark):
    shared = "\n".join(f"line {chr(97 + i)} of a text that has many near copies" for i in range(6))
    for n in (LEAST_DOCS - 1, LEAST_DOCS):
        found = check(spark, [(i, f"{shared}\nbut this is {chr(97 + i)}") for i in range(n)])
        assert all(r[3] >= 6 if n == LEAST_DOCS else r[3] == 0 for r in found)
