"""Boilerplate goes, groups of near copies stay: what the pipeline's line dedup counts as different documents."""

import random

from almanac.llm.lines import drop_recurring_lines


def test_boilerplate_goes_and_copies_stay(spark):
    rng = random.Random(12)

    def own(n):
        return " ".join(f"v{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}" for _ in range(n))

    header = " ".join(f"head{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(30))
    footer = " ".join(f"foot{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(25))
    docs = [(i, f"{header}\n{own(60)}\n{footer}") for i in range(300)]
    docs += [(1000 + i, f"page {i} was not found on this server today") for i in range(300)]
    # Thousands of near copies of one text: a word of some line is another in each, and some lack a line.
    lines = [own(18) for _ in range(20)]
    for i in range(1500):
        mine = [line.split(" ") for line in lines]
        for _ in range(rng.randrange(3)):
            line = rng.choice(mine)
            line[rng.randrange(3, len(line))] = f"edit{chr(97 + i % 26)}"
        del mine[rng.randrange(20) : 19 + rng.randrange(2) * 20 : 20]
        docs.append((2000 + i, "\n".join(" ".join(line) for line in mine)))
    docs += [(5000 + i, own(40) + "\n" + own(40)) for i in range(50)]
    found = drop_recurring_lines(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), by_copies=True)
    rows = {r.doc_id: (r.text, r.n_dropped) for r in found.selectExpr("doc.doc_id", "text", "n_dropped").collect()}
    texts = dict(docs)
    assert sum(rows[i][1] for i in range(300)) == 600
    assert all(rows[i][0] == texts[i].split("\n")[1] for i in range(300))
    assert sum(rows[1000 + i][1] for i in range(300)) == 300
    assert all(rows[i] == (texts[i], 0) for i in texts if i >= 2000)
