"""Main text of pages: the path scores against a direct computation, and deep nesting."""

from __future__ import annotations

import random
import time

import pytest

from meterloom.llm import pages

NAMES = "div p a b span li ul article header footer nav h1 td tr section form br".split()
MARKS = ["", "", "", ' class=ad', ' id="cookie-notice"', " role=navigation"]


def page(seed: int) -> str:
    draw = random.Random(seed)
    tags = [f"<{draw.choice(NAMES)}{draw.choice(MARKS)}>" for _ in range(25)] + [f"</{draw.choice(NAMES)}>" for _ in range(15)]
    texts = [draw.choice(["x", "Some words, with a point. ", "More of it; and so on, you know! " * 3]) for _ in range(40)]
    parts = tags + texts
    draw.shuffle(parts)
    return "".join(parts)


def parents(element):
    while element is not None:
        yield element
        element = element.parent


def direct_scores(found):
    """Scores by paths as text, every sum and neighbour written out."""
    def path(block):
        around = list(parents(block.element))
        names = [at.name for at in reversed(around) if at.block]
        return "/".join(names), any(at.named and not at.holds for at in around)

    paths = [path(block) for block in found]
    ratio = {}
    for p in set(paths):
        own = [block for block, other in zip(found, paths) if other == p]
        chars = sum(len(block.text) for block in own)
        points = sum(block.text.count(c) for block in own for c in ".,;:!?")
        links = sum(min(block.links, len(block.text)) for block in own)
        ratio[p] = (chars / len(own), points / len(own), 1 - links / chars, len(own))
    scores = dict.fromkeys(ratio, 0.0)
    for i, p in enumerate(paths):
        near = [(j, pages.KERNEL[abs(i - j)]) for j in range(len(paths)) if abs(i - j) <= 2]
        weight = sum(w for _, w in near)
        length = sum(w * ratio[paths[j]][0] for j, w in near) / weight
        points = sum(w * ratio[paths[j]][1] for j, w in near) / weight
        scores[p] += length * (1 + points) * ratio[p][2] / ratio[p][3]
    return paths, {p: score * (pages.LOWERED if p[1] else 1) for p, score in scores.items()}


@pytest.mark.parametrize("seed", range(60))
def test_path_scores_equal_a_direct_computation(seed):
    found = pages.blocks(page(seed))
    if not found:
        return
    pages.settle(pages._elements(found))
    scores = pages.path_scores(found)
    paths, direct = direct_scores(found)
    assert len(scores) == len(direct)
    for block, p in zip(found, paths):
        assert scores[block.path] == pytest.approx(direct[p])


def test_what_elements_take_from_those_around_them():
    for seed in range(60):
        found = pages.blocks(page(seed))
        pages.settle(pages._elements(found))
        for block in found:
            around = list(parents(block.element))
            assert block.element.heading == any(at.name in pages.HEADINGS for at in around)
            assert block.element.aside == any(at.named and not at.holds for at in around)
            assert block.element.leaf is next(at for at in around if at.block)


@pytest.mark.parametrize("piece", ["<div>word, ", "<div><p>word, ", "<span><a>word, ", "<b><i>word, </u>"])
def test_deep_nesting_loses_no_text_and_takes_time_in_proportion(piece):
    took = {}
    for times in (10_000, 40_000):
        start = time.process_time()
        words = " ".join(block.text for block in pages.blocks(piece * times))
        pages.main_text(piece * times)
        took[times] = time.process_time() - start
        assert words.count("word,") == times
    # Four times the page: sixteen times the time if each block walked to the root.
    assert took[40_000] < 9 * took[10_000] + 0.5
