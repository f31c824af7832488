from llm.quality import sampled


def test_the_classes_share_the_bytes():
    short = [(0, i, i, 100) for i in range(20)]
    long = [(1, i, 100 + i, 900 + 200 * (i % 2)) for i in range(20)]
    kept = sampled(short + long, 6000)
    assert kept[:20] == list(range(20))  # the class that is small leaves its rest
    assert sum(n for _, _, i, n in long if i in kept) > 3000
    assert {100, 101} <= set(kept)  # in hash order, not the shortest first


def test_a_text_too_long_is_passed_over():
    assert sampled([(0, 0, 1, 50), (0, 1, 2, 500), (0, 2, 3, 50)], 100) == [1, 3]
    assert sampled([], 100) == []
