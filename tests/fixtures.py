"""Hand-worked inputs and results."""

SENTENCES = [
    (0, "0", "Low tide"),
    (1, "1", "gulls circle the Harbour and the pier"),
    (2, "2", "a LOW bell"),
    (3, "3", "the tide turns at noon or later"),
    (4, "4", "Harbour lights"),
    (5, "5", "nobody rows out in fog"),
    (6, "6", "the bell again"),
]
SENTENCE_SCHEMA = "seq bigint, key string, value string"

LOWER_COUNTS = {
    **{"the": 4, "bell": 2, "harbour": 2, "low": 2, "tide": 2},
    **dict.fromkeys(
        "a again and at circle fog gulls in later lights nobody noon or out pier rows turns".split(), 1
    ),
}

# value, split on space, lower-cased and split on non-word runs
EDGE_TEXTS = [
    ("", [""], [""]),
    (" a", ["", "a"], ["", "a"]),
    ("a  ", ["a"], ["a"]),
    ("a  b", ["a", "", "b"], ["a", "b"]),
    ("   ", [], []),
    ("!hello", ["!hello"], ["", "hello"]),
    ("!!!", ["!!!"], []),
    ("It's ok.", ["It's", "ok."], ["it", "s", "ok"]),
    ("a \n", ["a", "\n"], ["a"]),
    ("Ünï cödé-ñ", ["Ünï", "cödé-ñ"], ["ünï", "cödé", "ñ"]),
    (None, None, None),
]

COLOUR_LINES = [
    (1, "alice,red"),
    (2, "bob,blue"),
    (3, "Alice,blue"),
    (4, "bob,yellow"),
    (5, None),
    (6, "nocomma"),
    (7, "carl, red"),
    (8, "dave,green,extra"),
    (9, "eve,"),
    (10, "bob,blue"),
    (11, ","),
    (12, ",red"),
]
COLOUR_SCHEMA = "seq bigint, value string"
COLOUR_UPDATES = [
    (1, "ALICE", "RED"),
    (2, "BOB", "BLUE"),
    (3, "ALICE", "BLUE"),
    (8, "DAVE", "GREEN"),
    (10, "BOB", "BLUE"),
    (12, "", "RED"),
]
COLOUR_CHANGES = [
    (1, "RED", 1),
    (2, "BLUE", 1),
    (3, "RED", 0),
    (3, "BLUE", 2),
    (8, "GREEN", 1),
    (10, "BLUE", 1),
    (10, "BLUE", 2),
    (12, "RED", 1),
]
COLOUR_COUNTS = {"BLUE": 2, "GREEN": 1, "RED": 1}
COLOUR_COUNTS_AT_10 = {"BLUE": 2, "GREEN": 1, "RED": 0}

# seq, key, id, amount, timestamp, state after
ACCOUNT_EVENTS = [
    (1, "1", 1, 500.0, 100, (1, 500.0, 100)),
    (2, "1", 1, 900.0, 50, (1, 500.0, 100)),
    (3, "1", 1, 700.0, 100, (1, 500.0, 100)),
    (4, "1", 1, 200.0, 150, (1, 200.0, 150)),
    (5, "2", 2, 300.0, 0, (2, 0.0, 0)),
    (6, "2", 2, 100.0, -5, (2, 0.0, 0)),
    (7, "3", 3, 50.0, 1, (3, 50.0, 1)),
    (8, "1", 9, 10.0, 60, (9, 200.0, 150)),
]
ACCOUNT_SCHEMA = "seq bigint, key string, id int, amount double, timestamp bigint"
ACCOUNTS = {"1": (9, 200.0, 150), "2": (2, 0.0, 0), "3": (3, 50.0, 1)}


def account_rows():
    return [event[:5] for event in ACCOUNT_EVENTS]
