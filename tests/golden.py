"""Nine posts, places and users that meet every edge case, as JSON lines."""

import json

FIELDS = ("ind", "followers", "poster", "category", "country", "at", "age", "first", "last", "joined")
ROWS = [
    (1, "900", "ann", "art", "UK", "2018-01-01T00:00:00", 18, "A", "One", "2015-01-01T00:00:00"),
    (2, "k", "bob", "art", "UK", "2022-12-31T23:59:59", 24, "B", None, "2020-12-31T23:59:59"),
    (3, "12k", "cy", "travel", "UK", "2017-12-31T23:59:59", 25, "C", "Three", "2014-12-31T23:59:59"),
    (4, "5000", "User Info Error", "travel", "FR", "2019-05-05T01:02:03", 35, "D", "Four", "2016-03-03T00:00:00"),
    (5, "700", "eve", None, "FR", "2019-06-06T00:00:00", 36, "E", "Five", "2016-04-04T00:00:00"),
    (6, "5000", "fay", "art", "DE", "2023-01-01T00:00:00", 50, "F", "Six", "2021-01-01T00:00:00"),
    (7, "User Info Error", "gus", "diy", "DE", "2020-02-29T12:00:00", 51, "G", "Seven", "2017-01-01T00:00:00"),
    (8, "40", "hal", "diy", "FR", "2020-07-07T00:00:00", 17, "H", "Eight", "2017-02-02T00:00:00"),
    (9, "60", "ida", "art", "UK", "2018-08-08T00:00:00", 22, "I", "Nine", "2015-09-09T00:00:00"),
]
OVERRIDES = {
    1: {"title": "No Title Data Available", "description": "No description available"},
    2: {"tag_list": "N,o, ,T,a,g,s, ,A,v,a,i,l,a,b,l,e"},
    3: {"image_src": "Image src error."},
}


def _records():
    return [dict(zip(FIELDS, row)) for row in ROWS]


def posts():
    return [
        {
            "category": r["category"],
            "description": f"d{r['ind']}",
            "downloaded": 1,
            "follower_count": r["followers"],
            "image_src": "x",
            "index": r["ind"],
            "is_image_or_video": "image",
            "poster_name": r["poster"],
            "save_location": f"Local save in /data/{r['category']}",
            "tag_list": "a,b",
            "title": f"t{r['ind']}",
            "unique_id": f"u{r['ind']}",
            **OVERRIDES.get(r["ind"], {}),
        }
        for r in _records()
    ]


def places():
    return [
        {
            "country": r["country"],
            "ind": r["ind"],
            "latitude": 1.5 * r["ind"],
            "longitude": -2.0 * r["ind"],
            "timestamp": r["at"],
        }
        for r in _records()
    ]


def users():
    return [
        {"age": r["age"], "date_joined": r["joined"], "first_name": r["first"], "ind": r["ind"], "last_name": r["last"]}
        for r in _records()
    ]


def write_lines(folder, records):
    folder.mkdir(parents=True)
    (folder / "part-0.json").write_text("".join(json.dumps(r) + "\n" for r in records))


def write_topics(root):
    """One topic folder per entity, records in partition 0; partition 1 holds a record no report may see."""
    for name, records in (("posts", posts()), ("places", places()), ("users", users())):
        write_lines(root / name / "partition=0", records)
        write_lines(root / name / "partition=1", [records[0]])
    return root
