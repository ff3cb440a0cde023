"""Synthetic positional payloads: values set at integer paths."""


def put(tree, path, value):
    """tree with value at the path; arrays grow with nulls."""
    at = tree
    for i, step in enumerate(path):
        while len(at) <= step:
            at.append(None)
        if i == len(path) - 1:
            at[step] = value
        else:
            if not isinstance(at[step], list):
                at[step] = []
            at = at[step]
    return tree


PLACE = {
    (27,): "https://maps.example/p", (11,): "Blue Heron", (13,): ["Restaurant", "Bar", 7], (18,): "Blue Heron, 7 Quay Lane, Aldmere 5120 ", (7, 0): "/url?q=http%3A%2F%2Fheron.example%2Fa%20b&opi=1", (178, 0, 0): "44 203117", (183, 2, 2, 0): "Q7HW+3V Aldmere",
    (4, 8): 118, (4, 7): 3.7, (9, 2): -12.25, (9, 3): 77.5, (34, 4, 4): "Closed", (32, 1, 1): "nice", (4, 3, 0): "https://reviews", (72, 0, 1, 6, 0): "https://thumb", (30,): "Etc/GMT-2", (4, 2): "$$$", (10,): "0x2f:0xa1", (78,): "PlaceIdA",
    (171, 0): [[None, None, "All", [[None] * 6 + [["https://img"]]]], [None, None, "", [[None] * 6 + [["https://none"]]]]], (46,): [["https://book", "book.example"], ["", "x"]], (38, 0): "https://menu", (38, 1): "menu.example", (57, 2): "8841", (57, 1): "Owner",
    (183, 1): ["borough", "street", "skipped", "Aldmere", "5120", "state", "QX"], (175, 3): [8, 5, 11, 40, 54],
    (203, 0): [["Monday", None, None, [["11–10 pm"], ["x"]]], ["Tuesday", ["9–5"]], ["Sunday", []], ["Monday", None, None, [["3–4 pm"]]]], (84, 0): [[1, [[18, 64], [19, 71]]], [7, [[9, 5]]], [9, [[1, 2]]]],
    (100, 1): [["svc", "Service", [["x", "Delivery", [None, [[1]]]], ["y", "", [None, [[1]]]], ["z", "Dine-in", [None, [[0]]]]]], ["empty", "Empty", []]],
    (75, 0, 1, 2): [[["order.example"], [None, None, ["https://order"]]]],
}


def place(cid="70211", **over):
    d = []
    for path, value in PLACE.items():
        put(d, path, value)
    root = [None] * 6 + [d]
    return put(root, (25, 3, 0, 13, 0, 0, 1), cid)
