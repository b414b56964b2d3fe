"""Rows that operators have to cope with."""

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, _curve string"
LONG = " ".join(f"word{i % 701} is number {i}," for i in range(6000))
BASE = " ".join(f"base{i}" for i in range(60))
TEXTS = [
    (1, BASE), (2, BASE), (2, BASE), (3, BASE + " tail"), (4, None), (5, ""), (6, "two words"), (7, "Two\tWORDS"),
    (8, LONG), (9, LONG + " more"), (None, BASE), (10, "\n \t"), (11, "日本語 テスト é́ 🙂 'tis don't <|endoftext|>"),
]
