"""Odd rows every operator has to take."""

LONG = "ein sehr langes Wort " * 20_000
ODD = [
    (1, None), (2, ""), (3, " \t\n "), (4, "one two three four five six seven"), (4, "one two three four five six seven"),
    (None, "no id at all, only words and words"), (7, LONG), (8, "ÄÖÜ é 漢字 😀 \x01\x02 mixed"), (9, "token"), (-5, "negative id"),
]
