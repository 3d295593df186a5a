"""Language identification, scoring, quality, decontamination, mixing and extraction."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import brute
from tests.llm.conftest import prose
from tillscope.llm import decontamination, gated_lm, importance, language_crf, lm_scoring, mixing
from tillscope.llm.decontamination import clean, contaminated
from tillscope.llm.language_id import identified, predict_languages
from tillscope.llm.page_parts import Weights, learn, main_text
from tillscope.llm.page_text import extract


def test_posteriors_are_exact():
    """Chunked forward-backward against the sum over all label sequences, and over long texts."""
    chance = np.random.default_rng(2)
    crf = language_crf.LanguageCrf(["a", "b"], moves=chance.standard_normal((2, 2)))
    factors = chance.random((70 + 3 + 1, 2)) + 0.05
    first = np.array([0, 70, 70, 73, 74])
    got = crf.posteriors(factors, first)
    step = np.exp(crf.moves)
    for low, high in ((0, 70), (70, 73), (73, 74)):
        word = factors[low:high]
        ahead = [np.full(2, 0.5)]
        for w in word:
            ahead.append((ahead[-1] @ step) * w)
        back = [np.ones(2)]
        for w in word[::-1]:
            back.append(step @ (w * back[-1]))
        back = back[::-1]
        want = np.array([ahead[t + 1] * back[t + 1] for t in range(len(word))])
        want /= want.sum(axis=1, keepdims=True)
        assert np.allclose(got[low:high], want)


LANGUAGES = {"en": "the and ing tion er".split(), "de": "der und ung keit sch".split(), "fr": "le et eau tion oi".split()}


def tongue(lang, seed, n=40):
    chance = random.Random(f"{lang}{seed}")
    return " ".join("".join(chance.choices(LANGUAGES[lang], k=chance.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def tongues(spark):
    rows = [(i, tongue(lang, i), lang) for i, lang in enumerate(list(LANGUAGES) * 40)]
    rows += [(900, None, "en"), (901, " 12 !?", "de"), (902, "", None), (903, tongue("de", 1, 60) + " " + tongue("en", 2, 20), None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_language(tongues, nothing):
    got = {r.doc_id: r for r in predict_languages(tongues).collect()}
    truth = {r.doc_id: r.lang for r in tongues.collect()}
    held = [i for i in range(120) if got[i].held_out]
    assert held and all(brute.remainder(i, 4) == 2 for i in held)
    assert np.mean([got[i].lang_pred == truth[i] for i in held]) >= 0.95
    assert [got[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3
    assert got[903].lang_pred == "de" and 0.5 < got[903].score < 0.95
    assert all(0 <= r.score <= 1 for r in got.values())
    kept = identified(tongues)
    assert kept.columns == tongues.columns and {r.doc_id for r in kept.collect()}.isdisjoint({900, 901, 902})
    assert predict_languages(nothing).count() == 0
    unlabelled = tongues.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r.lang_pred for r in predict_languages(unlabelled).collect()} == {"und"}
    assert identified(unlabelled).count() == tongues.count()


@pytest.mark.parametrize("head_words", [1 << 18, 40])
def test_base_score(docs, rows, monkeypatch, head_words):
    monkeypatch.setattr(lm_scoring, "HEAD_WORDS", head_words)
    got = {r.doc_id: r for r in lm_scoring.score_documents(docs).collect()}
    for i, (n, known, total, base) in brute.base_scores([(r[0], r[1]) for r in rows]).items():
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (n, known, total)
        assert got[i].base_score == pytest.approx(base) and got[i].score < 0
        assert got[i].held_out == (brute.remainder(i, 7) == 2)


def test_scores_without_rows(repeated, nothing):
    assert lm_scoring.score_documents(nothing).count() == 0
    assert lm_scoring.score_documents(repeated).count() == repeated.count()


def test_model_is_a_distribution_and_learns():
    """Chances of all tokens sum to one; a learned pattern scores better than its frequencies."""
    chance = np.random.default_rng(0)
    texts = [np.array([3, 4, 5, 6] * 10 + [0]) for _ in range(3000)]
    counts = np.bincount(np.concatenate(texts), minlength=gated_lm.WORDS + gated_lm.RARE_CLASSES).astype(float)
    model = gated_lm.train(texts, counts, 7)
    state = chance.standard_normal((1, gated_lm.STATE)).astype(np.float32)
    every = np.arange(gated_lm.WORDS + gated_lm.RARE_CLASSES)
    assert np.exp(model.log_chances(np.repeat(state, len(every), axis=0), every)).sum() == pytest.approx(1, abs=1e-3)
    ids = np.concatenate([texts[0], texts[0]])
    first = np.array([0, len(texts[0]), 2 * len(texts[0])])
    score = model.text_scores(ids, first)
    assert score[0] == pytest.approx(score[1], rel=1e-4)
    unigram = np.log(counts[texts[0]] / counts.sum()).sum()
    assert score[0] > 0.6 * unigram


def test_model_learns_from_all_texts(spark, monkeypatch):
    """Without any sample a pattern of the texts is learned in the tasks, in any order of rows."""
    monkeypatch.setattr(lm_scoring, "TRAIN_DOCUMENTS", 0)
    rows = [(i, " ".join(["we go out and come home"] * 60)) for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = lm_scoring.score_documents(frame).collect()
    held = [r for r in got if r.held_out]
    assert held and all(r.score > 0.8 * r.base_score for r in held)


def test_vocabulary_grows():
    """A larger corpus has more words with weights of their own; chances still sum to one."""
    assert gated_lm.room(7) == gated_lm.WORDS and gated_lm.room(262_144) == 262_144
    places = gated_lm.room(3000)
    assert 3000 <= places < 3100
    model = gated_lm.GatedModel.fresh(np.ones(places + gated_lm.RARE_CLASSES), 3000, 1)
    every = np.arange(places + gated_lm.RARE_CLASSES)
    chances = model.log_chances(np.ones((len(every), gated_lm.STATE), np.float32), every)
    assert np.exp(chances).sum() == pytest.approx(1, abs=1e-3) and len(set(chances[:3000])) > 2000


def test_gradient_matches_differences():
    chance = np.random.default_rng(1)
    counts = np.ones(gated_lm.WORDS + gated_lm.RARE_CLASSES)
    model = gated_lm.GatedModel.fresh(counts, gated_lm.WORDS, 3)
    for key, value in model.weights.items():
        model.weights[key] = value.astype(np.float64) * 3
    ids = chance.integers(0, gated_lm.WORDS + gated_lm.RARE_CLASSES, (2, 5))
    heads = np.zeros((2, 5), bool)
    heads[:, 0] = heads[1, 3] = True
    state = np.zeros((2, gated_lm.STATE))

    def loss():
        total, now = 0.0, state
        for t in range(5):
            now = np.where(heads[:, t, None], 0.0, now)
            total -= model.log_chances(now, ids[:, t]).sum()
            now, _ = model.step(ids[:, t], now)
        return total / 10

    grads, _ = gated_lm._window_gradient(model, ids, heads, state)
    for key in ("loop", "classes", "class_bias"):
        w = model.weights[key]
        at = tuple(chance.integers(0, s) for s in w.shape)
        before, w[at] = w[at], w[at] + 1e-5
        up = loss()
        w[at] = before - 1e-5
        down = loss()
        w[at] = before
        wanted = (up - down) / 2e-5
        assert grads[key][at] == pytest.approx(wanted, rel=2e-2, abs=1e-4)


def test_quality(spark, nothing):
    rows = [(i, prose(1, 50 + i) if i % 4 else prose(2, 40).replace(" ", "### ")) for i in range(200)]
    rows += [(500, None), (501, ""), (None, prose(1, 30)), (3, rows[3][1])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(0, 200, 2)], "doc_id long, quality int, toxic int")
    got = importance.resampled(frame, labels).collect()
    assert len(got) == len(rows)
    assert all(r.kept == bool(r.doc_id % 4) for r in got if r.doc_id is not None and r.doc_id < 500)
    assert not any(r.kept for r in got if r.doc_id in (500, 501))
    half = importance.resampled(frame, labels, keep=0.5).collect()
    assert sum(r.kept for r in half) == pytest.approx(len(rows) / 2, abs=2)
    assert sorted(r.draw_key for r in half if r.kept)[0] > max(r.draw_key for r in half if not r.kept)
    assert importance.resampled(nothing, labels).count() == 0
    assert importance.resampled(frame, labels.limit(0)).select("log_weight").distinct().count() == 1


def smith_waterman(a, b):
    table = [[0.0] * (len(b) + 1) for _ in range(len(a) + 1)]
    best = 0.0
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            table[i][j] = max(
                0.0, table[i - 1][j - 1] + (1.0 if x == y else -0.5), table[i - 1][j] - 0.5, table[i][j - 1] - 0.5
            )
            best = max(best, table[i][j])
    return best / len(a)


def test_alignment_against_plain():
    chance = random.Random(4)
    items = decontamination.Items([1, 2], ["a b c d e f g h", "a c e g i k m"])
    texts = [" ".join(chance.choices("abcdefghikmz", k=25)) for _ in range(30)]
    from tillscope.llm.textarrays import LETTER_WORDS, utf8, words

    hashes, _, first = words(*utf8(pa.array(texts)), LETTER_WORDS)
    windows = np.array([[t, i, first[t], first[t + 1]] for t in range(30) for i in range(2)])
    got = items._align(windows, hashes)
    names = [list("abcdefgh"), list("acegikm")]
    assert got.tolist() == [smith_waterman(names[i], texts[t].split()) for t in range(30) for i in range(2)]


def test_decontamination(spark, docs, nothing):
    items = [(i, prose(1000 + i, 40)) for i in range(5)] + [(9, prose(1000, 40)), (10, "too short"), (11, None), (None, "a b c d e")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    chance = random.Random(7)
    edited = items[1][1].split()
    for at in chance.sample(range(40), 8):
        edited[at] = "changed"
    del edited[20], edited[30]
    rows = [
        (0, prose(50, 80) + " " + items[0][1].upper() + ". " + prose(51, 80)),
        (1, prose(52, 200) + "\n" + ", ".join(edited)),
        (2, prose(53, 300)), (3, None), (4, ""), (5, " ".join(items[2][1].split()[:10]) + " " + prose(54, 100)),
        (0, items[3][1]), (None, items[4][1]),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in contaminated(frame, benchmark).collect()}
    assert set(got) == {(0, 0), (1, 1), (0, 3), (None, 4)}
    assert got[0, 0] == 1.0 and 0.5 <= got[1, 1] < 1
    assert sorted(r.doc_id for r in clean(frame, benchmark).collect()) == [2, 3, 4, 5]
    assert clean(docs, benchmark).columns == docs.columns
    assert clean(docs, benchmark).count() == docs.count()
    assert contaminated(nothing, benchmark).count() == 0
    assert contaminated(frame, benchmark.limit(0)).count() == 0
    assert clean(frame, benchmark.limit(0)).count() == len(rows)


def targets(sizes):
    """Water-filling by repetition."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    left, open_names, result = 1.5 * sum(sizes.values()), set(names), {}
    while open_names:
        unit = left / sum(weight[s] for s in open_names)
        full = {s for s in open_names if weight[s] * unit > 2 * sizes[s]}
        if not full:
            return result | {s: weight[s] * unit for s in open_names}
        for s in full:
            result[s] = 2 * sizes[s]
            left -= 2 * sizes[s]
        open_names -= full
    return result


def test_mix(docs, rows, repeated, nothing):
    got = {r.doc_id: r for r in mixing.mix_sources(docs).collect()}
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(brute.words(r[1]))
    wanted = targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in rows:
        own = got[r[0]]
        assert own.size == len(brute.words(r[1])) and 0 <= own.taken <= 2 * own.size
        assert own.source_size == sizes[r[3]] and own.target == pytest.approx(wanted[r[3]])
        taken[r[3]] += own.taken
    for source in sizes:
        assert taken[source] == pytest.approx(wanted[source], abs=2 * mixing.BLOCK_WORDS)
    again = {r.doc_id: r for r in mixing.mix_sources(docs.repartition(5)).collect()}
    assert again == got
    assert mixing.mix_sources(repeated).count() == repeated.count()
    assert mixing.mix_sources(nothing).count() == 0
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == [*docs.columns, "taken_"]
    assert {r.doc_id for r in mixed.collect()} == {i for i, r in got.items() if r.taken}
    assert mixing.mixed_documents(nothing).count() == 0


def test_highest_quotients(spark):
    """Seats by the rule itself: the largest quotients win, ties by name."""
    votes = {"a": 53.0, "b": 24.0, "c": 23.0, "d": 0.0, "e": 0.4}
    frame = spark.createDataFrame([(k, v, 7) for k, v in votes.items()], "name string, quota double, seats long")
    quotients = sorted(((-v / (2 * k + 1), name) for name, v in votes.items() for k in range(20)))
    wanted = dict.fromkeys(votes, 0)
    for _, name in quotients[:7]:
        wanted[name] += 1
    got = {r.name: r.blocks for r in mixing.sainte_lague(frame, [], "seats", "quota", ["name"]).collect()}
    assert got == wanted


PAGE = (
    "<html><head><title>T</title><style>p{}</style><script>var a='</p>';</script></head><body>"
    "<header>Site name</header><nav><ul><li><a href='/'>Home</a></li></ul></nav>"
    "<div class='cookie-notice'>We use cookies</div><article><header><h1>A  title</h1></header>"
    "<p>First &amp; <b>bo</b>ld<br>line.</p><div class='ad'>Buy now</div><p>Second &#233;<p>Third"
    "<form>Name <input name=x></form><section class='comments'><p>Nice post</p></section></article>"
    "<aside>More</aside><footer>&copy; us</footer></body></html>"
)


def test_page():
    weights = learn([PAGE] * 3)
    assert main_text(PAGE, weights) == "A title First & bold line. Second é Third"
    assert main_text(PAGE.replace("article", "main"), weights) == "A title First & bold line. Second é Third"
    unmarked = PAGE.replace("<article>", "<div class=post>").replace("</article>", "</div>").replace("<header><h1>A  title</h1></header>", "<h1>A  title</h1>")
    assert main_text(unmarked, weights) == "A title First & bold line. Second é Third"
    for broken in ("", "   ", "<p", "<!-- never closed <p>x", "<script>only", "<nav>menu</nav>", "</p></div>"):
        assert main_text(broken, weights) == ""
    assert main_text("plain a < b words <", weights) == "plain a < b words <"
    assert main_text("<p>cut off here <a hr", weights) == "cut off here"
    assert main_text("<div>" * 3000 + "<p>deep</p>", Weights({}, {}, 0.1)) == "deep"


def test_pages(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (3, "v", ""), (None, "w", "<p>" + "long words " * 20_000)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    got = extract(pages).collect()
    assert [r.text for r in got[:4]] == ["A title First & bold line. Second é Third"] * 2 + ["", ""]
    assert got[4].n_chars == len(got[4].text) == len("long words " * 20_000) - 1
    assert extract(pages.limit(0)).count() == 0
