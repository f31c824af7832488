import random
import re
import time

from llm import secret_scan

PLAIN = re.compile(r"""[A-Za-z][A-Za-z0-9+.-]*://[^\s"'<>]+""")


def test_same_spans_as_the_pattern():
    r = random.Random(2)
    texts = ["", "://", "a://", "9a://x", "+-.://x", "a://b://c d://", "é://x aé://y", "a:///", "x://y<z://w"]
    texts += ["".join(r.choice("ab9+:/ <é'-\n") if r.random() < 0.7 else "://"
                      for _ in range(r.randrange(60))) for _ in range(3000)]
    for text in texts:
        assert secret_scan.addresses(text) == [m.span() for m in PLAIN.finditer(text)], text


def test_a_long_run_takes_linear_time():
    text = "a" * 1_000_000 + " " + "b" * 1_000_000 + "://host/path " + "c+" * 500_000
    began = time.perf_counter()
    assert secret_scan.addresses(text) == [(1_000_001, 2_000_013)]
    assert time.perf_counter() - began < 5
