"""Furniture of generated pages: recall and precision on small and large sites, and what must stay."""

import random

import pytest

from graphloom.llm import boilerplate

SCHEMA = "chunk_id bigint, chunk_ix int, text string, metadata struct<section_title:string,source:string,title:string,type:string>"


def pages(rng, n, host):
    """(text, title, address, furniture line numbers) of pages with menus, teasers, tags, a labelled link and a footer around an article."""
    word = lambda: "".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(2, 4)))
    common = [word() for _ in range(60)]
    words = lambda k: " ".join(rng.choice(common) if rng.random() < 0.6 else word() for _ in range(k))
    sentence = lambda: words(rng.randint(8, 14)).capitalize() + "."
    titles = [f"{words(3)} for the {words(2)}".capitalize() for _ in range(n)]
    menu = " | ".join(word().capitalize() for _ in range(5))
    for i, title in enumerate(titles):
        furniture = lambda t: (t, True)
        lines = [furniture(menu), furniture(f"Home > {rng.choice(['News', 'Topics'])} > {title}"), (title, False), (sentence(), False)]
        lines += [(f"How {words(2)} rebuilt their {words(3)}", False), (sentence() + " " + sentence(), False)]
        if rng.random() < 0.5:
            lines += [furniture("Read also: " + rng.choice(titles)), (sentence(), False)]
        if rng.random() < 0.7:
            lines += [furniture("Latest news"), *(furniture(rng.choice(titles)) for _ in range(3))]
        lines += [furniture(" ".join("#" + rng.choice(common) for _ in range(3))), furniture("We use cookies to count visits."), furniture("Privacy policy"), furniture("Back to top")]
        yield "\n".join(x for x, _ in lines), title, f"https://{host}/{i}", {k for k, (_, f) in enumerate(lines, 1) if f}, lines


@pytest.mark.parametrize("n", [25, 400])
def test_recall_and_precision(spark, n):
    rng = random.Random(n)
    rows, true, subheads, k = [], set(), set(), 0
    for host in ("www.reef-watch.example", "news.hill-post.example"):
        for text, title, address, bad, lines in pages(rng, n, host):
            rows.append((k, 0, text, (None, address, title, "web")))
            true |= {(k, x) for x in bad}
            subheads |= {(k, x) for x, (t, f) in enumerate(lines, 1) if t.startswith("How ") and not f}
            k += 1
    got = {(r.chunk_id, r.line_no) for r in boilerplate.judge(spark.createDataFrame(rows, SCHEMA)).where("furniture").collect()}
    recall, precision = len(got & true) / len(true), len(got & true) / len(got)
    assert recall >= 0.97 and precision >= 0.97, (recall, precision)
    # a subheading of seven words is no furniture for its length
    assert len(got & subheads) <= 0.02 * len(subheads)
