"""Tables, XML record layout, domains and constraints of the bibliography."""

from __future__ import annotations

# --- fixed values: record elements, value domains, tables and constraints of the data format --
PUBLICATION_TAGS = ["article", "inproceedings", "proceedings", "book", "incollection",
                    "phdthesis", "mastersthesis", "www"]
OTHER_TAGS = ["person", "data"]
RECORD_TAGS = PUBLICATION_TAGS + OTHER_TAGS
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august",
          "september", "october", "november", "december"]
PUBLICATION_TYPES = ["habil", "withdrawn", "survey", "informal withdrawn", "noshow",
                     "disambiguation", "data", "software", "encyclopedia", "edited", "group",
                     "informal"]
ISBN_TYPES = ["usb", "print", "online", "electronic"]
URL_TYPES = ["archive", "deprecated"]
NOTE_TYPES = ["source", "rating", "uname", "reviewid", "disstype", "affiliation", "doi",
              "isnot", "isbn", "award"]

# Parquet and CSV layout of each table.
TABLES = {
    "author": "person_id long, publication_key string, bibtex string, aux string",
    "editor": "person_id long, publication_key string",
    "person": "id long, full_name string, orcid string",
    "publication": (
        "key string, category string, title string, year smallint, booktitle string, "
        "pages string, address string, journal string, volume smallint, number string, "
        "month string, month_num int, cdrom string, chapter smallint, publnr smallint, "
        "cdate date, mdate date, type string, title_bibtex string, reviewid string, "
        "rating string, school_id long, publisher_id long, series_id long"
    ),
    "electronic_edition": (
        "id long, url string, publication_key string, is_archive boolean, is_oa boolean"
    ),
    "cite": "id long, str string, publication_key string, label string, ref string",
    "crossref": "id long, str string, publication_key string",
    "isbn": "id long, isbn string, publication_key string, type string",
    "note": "id long, note string, label string, type string, publication_key string",
    "url": "id long, url string, type string, publication_key string",
    "publisher": "id long, name string, href string",
    "series": "id long, name string, href string",
    "school": "id long, name string",
}

PRIMARY_KEYS = {
    "author": ["person_id", "publication_key"],
    "editor": ["person_id", "publication_key"],
    "publication": ["key"],
    **{t: ["id"] for t in ("person", "electronic_edition", "cite", "crossref", "isbn", "note",
                           "url", "publisher", "series", "school")},
}

NOT_NULL = {
    "author": ["person_id", "publication_key"],
    "editor": ["person_id", "publication_key"],
    "person": ["id", "full_name"],
    "publication": ["key", "category"],
    "electronic_edition": ["id", "url", "publication_key", "is_archive", "is_oa"],
    "cite": ["id", "str", "publication_key"],
    "crossref": ["id", "str", "publication_key"],
    "isbn": ["id", "isbn", "publication_key"],
    "note": ["id", "note", "publication_key"],
    "url": ["id", "url", "publication_key"],
    "publisher": ["id"],
    "series": ["id", "name"],
    "school": ["id", "name"],
}

# Values of columns that a file leaves blank.
DEFAULTS = {"electronic_edition": {"is_archive": False, "is_oa": False}}

# (table, columns, rows the rule covers); rows with a null in the columns never collide.
UNIQUE = [
    ("person", ["full_name", "orcid"], None),
    ("person", ["full_name"], "orcid is null"),
    ("publisher", ["name"], None),
    ("school", ["name"], None),
    ("series", ["name"], None),
]

_PER_PUBLICATION = ["author", "editor", "electronic_edition", "cite", "crossref", "isbn", "note",
                    "url"]
# (child table, column, parent table, column)
FOREIGN_KEYS = [
    ("author", "person_id", "person", "id"),
    ("editor", "person_id", "person", "id"),
    *[(t, "publication_key", "publication", "key") for t in _PER_PUBLICATION],
    *[("publication", f"{t}_id", t, "id") for t in ("publisher", "school", "series")],
]

DOMAINS = {
    ("publication", "category"): PUBLICATION_TAGS,
    ("publication", "month"): MONTHS,
    ("publication", "type"): PUBLICATION_TYPES,
    ("isbn", "type"): ISBN_TYPES,
    ("url", "type"): URL_TYPES,
    ("note", "type"): NOTE_TYPES,
}

WIDTHS = {
    ("publication", "key"): 80,
    **{(t, "publication_key"): 80 for t in _PER_PUBLICATION},
    ("person", "orcid"): 19,
    ("isbn", "isbn"): 18,
}
# ---------------------------------------------------------------------------------------------


def _element(*attributes: str) -> str:
    fields = ", ".join(["_VALUE: string", *[f"_{a}: string" for a in attributes]])
    return f"array<struct<{fields}>>"


# How one record is parsed: attributes carry "_", children are kept in document order. Plain
# string children keep nested markup.
RECORD_SCHEMA = ", ".join(
    [f"_{a} string" for a in ("key", "mdate", "publtype", "cdate", "reviewid", "rating")]
    + [f"{c} array<string>" for c in ("title", "booktitle", "pages", "year", "address", "journal",
                                      "volume", "number", "month", "cdrom", "chapter", "publnr",
                                      "school")]
    + [f"author {_element('orcid', 'bibtex', 'aux')}", f"editor {_element('orcid', 'aux')}",
       f"ee {_element('type')}", f"cite {_element('label', 'ref')}", f"crossref {_element()}",
       f"note {_element('type', 'label')}", f"url {_element('type')}",
       f"isbn {_element('type')}", f"publisher {_element('href')}",
       f"series {_element('href')}", "_corrupt_record string"]
)
