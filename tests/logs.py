"""Event logs made for tests, from the fields of its record types."""

import base64
import collections
import hashlib
import json

from lectern.sources.contract import BYTE_FIELDS

NUMBERS = {"ordinal", "artifact_id", "index", "size", "contract_version"}


def value(data):
    """A byte value; utf8 is there only for text."""
    raw = data if isinstance(data, bytes) else data.encode()
    made = dict(zip(("base64", "encoding", "size", "sha256"), (base64.b64encode(raw).decode("ascii"), "base64", len(raw), hashlib.sha256(raw).hexdigest()), strict=True))
    text = raw.decode("utf-8", "ignore")
    return made | {"utf8": text} if text.encode() == raw else made


#: The fields that a record of each type has.
FIELDS = {
    "header": "contract contract_version command producer producer_version sword_version",
    "module": "classification name description language driver direction encoding markup",
    "config_entry": "ordinal name value",
    "entry": "ordinal key scope raw rendered_default stripped",
    "artifact_begin": "artifact_id file_type path",
    "artifact_chunk": "artifact_id index data",
    "artifact_end": "artifact_id size sha256",
    "diagnostic": "severity",
}


def record(type, **given):
    """A record of a type: its fields as given, else a byte value of the field's name, a zero or a letter."""
    plain = lambda name: value(name) if name in BYTE_FIELDS else 0 if name in NUMBERS else "x"
    return {"type": type} | {name: given[name] if name in given else plain(name) for name in FIELDS[type].split()}


def entry(ordinal, domain, book, chapter, verse, raw, stripped=None, testament=1, nr=1):
    scope = {"type": "verse_key", "testament": testament, "book": nr, "chapter": chapter, "verse": verse, "intro_scope": domain, "book_name": value(book)}
    return record("entry", ordinal=ordinal, scope=scope, raw=value(raw), rendered_default=value(raw), stripped=value(raw if stripped is None else stripped))


def records(entries, module="Mod", config=()):
    parts = [b"ab", b"\xff"]
    coded = {"direction": {"code": 1, "name": "ltr"}, "encoding": {"code": 1, "name": "UTF-8"}, "markup": {"code": 1, "name": "OSIS"}}
    made = [record("header", contract_version=1, command="extract", producer_version="1.0.0"), record("module", classification="bible", name=value(module), description=value("A test"), language=value("xx"), **coded)]
    made += [record("config_entry", ordinal=n, name=value(k), value=value(v)) for n, (k, v) in enumerate(config)]
    made += entries
    made.append(record("artifact_begin", file_type="regular", path=value("a/b.txt")))
    made += [record("artifact_chunk", index=n, data=value(x)) for n, x in enumerate(parts)]
    made += [record("artifact_end", size=sum(map(len, parts)), sha256=hashlib.sha256(b"".join(parts)).hexdigest()), record("diagnostic", severity="warning")]
    return [{"sequence": n, **x} for n, x in enumerate(made)]


def footer(rows, lines, **changed):
    of = collections.Counter(x["type"] for x in rows)
    ends = [x for x in rows if x["type"] == "artifact_end"]
    severities = collections.Counter(x["severity"] for x in rows if x["type"] == "diagnostic")
    digest = hashlib.sha256()
    for line in lines:
        digest.update(line.encode())
    totals = {"entries": of["entry"], "artifacts": len(ends), "artifact_bytes": sum(x["size"] for x in ends)}
    return {"type": "footer", "sequence": len(rows), "success": True, **totals, "counts": dict(of), "diagnostics": {s: severities[s] for s in ("error", "info", "warning")}, "stream_sha256": digest.hexdigest()} | changed


def log(rows, **changed):
    """The text of a log with a footer that is right but for what is changed."""
    lines = [f"{json.dumps(x, ensure_ascii=False)}\n" for x in rows]
    return "".join([*lines, f"{json.dumps(footer(rows, lines, **changed))}\n"])
