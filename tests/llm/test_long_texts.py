"""Long and deep texts cost time in proportion to their length."""

import random
import string
import time

from lakemill.llm import html_text, secret_scan


def timed(call, text):
    start = time.process_time()
    out = call(text)
    return time.process_time() - start, out


def test_deep_pages():
    for piece in ("<div>", "<p><b>x</b><i>", "<table><tr><td><ul><li>"):
        small, _ = timed(html_text.lines_of, piece * (100_000 // len(piece)))
        large, _ = timed(html_text.lines_of, piece * (1_000_000 // len(piece)))
        assert large < 10 and large < 40 * max(small, 0.05)


def test_many_placeholders_and_windows():
    draw = random.Random(1)
    words = ["exampleA1b2", "x9Kq2LmZ8v", "sample", "QwE7rT"]
    text = "".join(draw.choice(words) for _ in range(120_000))
    seconds, spans = timed(secret_scan.entropy_spans, text)
    assert spans and seconds < 60


def test_placeholders_found_by_place_equal_all_pairs():
    draw = random.Random(2)
    for _ in range(60):
        text = "".join(draw.choice(["example", "abcdefghij", "".join(draw.choices(string.ascii_letters + string.digits, k=9)), "-"]) for _ in range(30))
        harmless, excused = secret_scan.placeholders(text, 0)
        for a, b in secret_scan.entropy_spans(text):
            assert not any(a < y and x < b for x, y in harmless)
        assert harmless == sorted(harmless) and excused == sorted(excused)


def test_keys_of_letters_with_last_digits_are_no_file_names():
    assert secret_scan.entropy_spans("key wJalrXUtnFEMIKMDENGbPxRfiCYz7391 end")
    for name in ("internationalizationTest2024", "some-file-name-of-things-2024", "SomeCamelCaseFileNameIsHere12", "BUILD_OUTPUT_FOLDER_2024"):
        assert not secret_scan.entropy_spans(name)
