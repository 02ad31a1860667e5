import random

import pytest

from leafmill.functions.rules import FIGURE_RULES, NO_RULE, Rule
from leafmill.operators import context as X

BLOCKS = "doc_id string, ord bigint, page int, text string"
FIGURES = "doc_id string, figure_id string, page int, caption string"


def classify(spark, blocks, figures, rules=FIGURE_RULES, **kw):
    got = X.classify_figures(
        spark.createDataFrame(figures, FIGURES), spark.createDataFrame(blocks, BLOCKS), rules, **kw
    )
    return {r.figure_id: (r.classification.type, r.classification.confidence) for r in got.collect()}


def test_only_the_same_page_counts_and_captions_go_first(spark):
    blocks = [("d", 1, 1, "see table 1 and a state"), ("d", 2, 2, "plain"), ("e", 1, 2, "plot")]
    figures = [("d", "f1", 1, ""), ("d", "f2", 2, ""), ("d", "f3", 9, None), ("d", "f4", 1, "a Table")]
    assert classify(spark, blocks, figures) == {
        "f1": ("state_machine", 0.88),
        "f2": ("other", 0.4),
        "f3": ("other", 0.4),
        "f4": ("table_image", 0.75),
    }


@pytest.mark.parametrize("width", [1, 2, 4096])
def test_needles_that_straddle_blocks(spark, width):
    blocks = [("d", 1, 1, "a block"), ("d", 2, 1, "diagram here"), ("d", 3, 2, "diagram"), ("d", 5, 3, "x" * 195 + "timing")]
    figures = [("d", "f1", 1, ""), ("d", "f2", 2, "The Block"), ("d", "f3", 3, "")]
    assert classify(spark, blocks, figures, width=width) == {
        "f1": ("block_diagram", 0.9),
        "f2": ("block_diagram", 0.9),
        "f3": ("other", 0.4),
    }


@pytest.mark.parametrize("width", [1, 2, 3, 50])
def test_against_a_loop(spark, width):
    rng = random.Random(width)
    rules = (
        Rule(("zz",), "caption", 0.1, "c", caption_only=True),
        Rule(("a b", "b a c"), "one", 0.2, "o"),
        Rule(("cc a a", "a a a b"), "two", 0.3, "t"),
        Rule(("b c b",), "three", 0.4, "h"),
    )
    blocks, figures = [], []
    for page in range(1, 25):
        for i in range(rng.randint(0, 9)):
            text = " ".join(rng.choices("abc", k=rng.randint(0, 3)))
            blocks.append(("d", page * 100 + i * rng.randint(1, 2) * 3 + i, page, text))
        figures.append(("d", f"f{page}", page, " ".join(rng.choices("abc", k=rng.randint(0, 2)))))
    blocks = list({b[1]: b for b in blocks}.values())
    want = {}
    for _, fid, page, caption in figures:
        ctx = " ".join(t[:200] for _, o, p, t in sorted(blocks, key=lambda b: b[1]) if p == page)
        hay = f"{caption} {ctx}".lower()
        want[fid] = next(
            (r.label for r in rules if any(n in (caption if r.caption_only else hay) for n in r.needles)),
            NO_RULE.label,
        )
    got = classify(spark, blocks, figures, rules, width=width)
    assert {k: v[0] for k, v in got.items()} == want
