"""Texts that every operator has to bear."""

LONG = " ".join(f"word{i % 997} and{i % 31}" for i in range(20_000))
MIXED = ["", None, " ", "\n\n", "one", "ein Wörtchen ß", "日本語 テキスト", "tab\tand\x0bfeed\x0c", "x" * 3000, "a  b   c "]
