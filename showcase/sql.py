"""Building blocks of the comparison SQL. It works on the plain columns of the tables and
never sees JSON."""

from __future__ import annotations

from showcase.feeds import EVENTS_UNTIL, ORDERS_UNTIL, PAGE_BROKEN, PAGE_DELETED, PAGE_OLD, TURNS_PER_DOC

EVENTS_BEFORE = f"ts < TIMESTAMP '{EVENTS_UNTIL}'"
EVENTS_SINCE = f"ts >= TIMESTAMP '{EVENTS_UNTIL}'"
ORDERS_BEFORE = f"o_orderdate < TIMESTAMP '{ORDERS_UNTIL}'"


def select(columns: dict[str, str], rows: str) -> str:
    return "SELECT " + ", ".join(f'{e} AS "{n}"' for n, e in columns.items()) + f" FROM {rows}"


def names(columns) -> str:
    return ", ".join(f'"{n}"' for n in columns)


def with_(ctes: dict[str, str], body: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({q})" for n, q in ctes.items()) + "\n" + body


def merged(columns, same: str, *, t: str = "t", s: str = "s", insert_deletes: bool = True, newer: str = "true") -> str:
    """Merge of `s` into `t`; both have the columns, `s` also "Op"."""
    kept = f"SELECT {_columns('t', columns)} FROM {t} t ANTI JOIN {s} s ON {same} AND {newer}"
    # a delete that finds its row goes with it; others come in
    deletes = f"SELECT s.* FROM {s} s ANTI JOIN {t} t ON {same} WHERE s.\"Op\" = 'D'" if insert_deletes else None
    rest = f"SELECT s.* FROM {s} s WHERE s.\"Op\" <> 'D'"
    live = rest if newer == "true" else f"SELECT s.* FROM ({rest}) s ANTI JOIN {t} t ON {same} AND NOT ({newer})"
    added = " UNION ALL ".join(f"SELECT {_columns('s', columns)} FROM ({q}) s" for q in (live, deletes) if q)
    return f"{kept} UNION ALL {added}"


def _columns(side: str, columns) -> str:
    return ", ".join(f'{side}."{n}"' for n in columns)


# events

EVENT_OP = "CASE event_type WHEN 'error' THEN 'D' WHEN 'signup' THEN 'I' ELSE 'U' END"
EVENT = {
    "_orig_id": "user_id::VARCHAR",
    "transact_seq": "event_id",
    "transact_change_timestamp": "epoch_us(ts) // 1000",
    "_id": "user_id::VARCHAR",
    "event_type": "event_type",
    "value": "value",
    "at": "epoch_us(ts) // 1000",
}
EVENT_CHANGE = {"Op": EVENT_OP, **EVENT}


def newest_events(where: str = "true") -> str:
    return (
        f"(SELECT * FROM events WHERE {where} "
        "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)"
    )


# orders and lineitem

LINES = """SELECT l_orderkey, l_linenumber, count(*) AS n, min(l_returnflag) AS flag,
  count(*) FILTER (l_returnflag <> 'R') AS kept_n, min(l_returnflag) FILTER (l_returnflag <> 'R') AS kept_flag
  FROM lineitem GROUP BY l_orderkey, l_linenumber"""
ORDER_OP = "CASE o_orderstatus WHEN 'F' THEN 'D' WHEN 'P' THEN 'I' ELSE 'U' END"
PLACED = "epoch_ms(o_orderdate)"
FINAL = "CASE WHEN o_orderstatus = 'F' THEN epoch_ms(o_orderdate) END"
NO_TEXT = "NULL::VARCHAR"


def report(version: int) -> dict[str, str]:
    return {
        "_orig_id": "o_orderkey::VARCHAR",
        "transact_seq": f"{version}::BIGINT",
        "transact_change_timestamp": PLACED,
        "_class": "'order'",
        "_id": "o_orderkey::VARCHAR",
        "completedDate": FINAL,
        "ehr": "o_orderpriority",
        "fromDate": PLACED,
        "location": NO_TEXT,
        "message": "'order ' || o_orderkey",
        "npi": "o_custkey::VARCHAR",
        "numOfRetries": f"{version}::BIGINT",
        "orginalReportId": "o_orderkey::VARCHAR",
        "physician": NO_TEXT,
        "practice": NO_TEXT,
        "priority": "o_orderpriority",
        "sentToRPATime": "NULL::BIGINT",
        "singleThreaded": "o_orderstatus = 'F'",
        "status": "'N'" if version == 1 else "o_orderstatus",
        "study": NO_TEXT,
        "toDate": PLACED,
        "type": "'report'",
        "uploadTime": PLACED,
        "practiceId": "o_custkey",
        "completedTime": FINAL,
        "patient__id": "l_linenumber::VARCHAR",
        "patient_numOfRetries": "n" if version == 1 else "kept_n",
        "patient_status": "flag" if version == 1 else "kept_flag",
    }


REPORT = list(report(1))
ORDER_LINES_1 = f"orders LEFT JOIN lines ON o_orderkey = l_orderkey WHERE {ORDERS_BEFORE}"
ORDER_LINES_2 = "orders LEFT JOIN lines ON o_orderkey = l_orderkey AND kept_n > 0"
REPORTS = {
    "lines": LINES,
    "t": select(report(1), ORDER_LINES_1),
    "s": select({"Op": ORDER_OP, **report(2)}, ORDER_LINES_2),
}
REPORT_KEY = "s._id = t._id AND s.patient__id = t.patient__id"


def upload(version: int) -> dict[str, str]:
    return {
        "_orig_id": "o_orderkey::VARCHAR",
        "transact_seq": f"{version}::BIGINT",
        "transact_change_timestamp": PLACED,
        "_class": "'upload'",
        "_id": "o_orderkey::VARCHAR",
        "ehr": "o_orderpriority",
        "fromDate": PLACED,
        "location": NO_TEXT,
        "npi": "o_custkey::VARCHAR",
        "physician": NO_TEXT,
        "practice": NO_TEXT,
        "priority": NO_TEXT,
        "study": NO_TEXT,
        "toDate": PLACED,
        "type": "'first'" if version == 1 else "'second'",
        "uploadId": "o_orderkey::VARCHAR",
        "uploadTime": PLACED,
        "fileName": "'line-' || l_linenumber",
        "inputType": "flag" if version == 1 else "kept_flag",
    }


UPLOAD = list(upload(1))
UPLOADS = {
    "lines": LINES,
    "t": select(upload(1), ORDER_LINES_1),
    "s": select(
        {"Op": ORDER_OP, **upload(2)}, "orders JOIN lines ON o_orderkey = l_orderkey AND kept_n > 0"
    ),
}
UPLOAD_KEY = 's._id = t._id AND s."fileName" = t."fileName"'

# conversations

PARTS = f"""SELECT *, conv_id || '-' || (turn // {TURNS_PER_DOC}) AS part FROM conversations"""
DOCS = """SELECT part, max(conv_id) AS doc_conv, bool_or(role = 'system') AS has_system FROM parts GROUP BY part"""


def access(version: int) -> dict[str, str]:
    return {
        "_orig_id": "d.part",
        "transact_seq": f"{version}::BIGINT",
        "transact_change_timestamp": "d.doc_conv * 1000",
        "_class": "'access'",
        "_id": "d.part",
        "ehr": f"'v{version}'",
        "isSuspended": "d.has_system",
        "practice": NO_TEXT,
        "practiceId": "d.doc_conv::VARCHAR",
        "audit_audit": "p.role",
        "audit_date": "p.turn",
        "audit_newValue": "p.text",
        "audit_originalValue": NO_TEXT,
        "audit_reportId": "p.turn::VARCHAR",
        "audit_user": "p.role",
    }


ACCESS = list(access(1))
ACCESSES = {
    "parts": PARTS,
    "docs": DOCS,
    "t": select(access(1), "docs d LEFT JOIN parts p ON d.part = p.part AND p.role = 'user'"),
    "s": select(
        {"Op": "CASE WHEN d.has_system THEN 'D' ELSE 'U' END", **access(2)}, "docs d JOIN parts p ON d.part = p.part"
    ),
}
ACCESS_KEY = 's._id = t._id AND s."audit_reportId" = t."audit_reportId"'

# pages


def error(version: int, null_when: str = "false") -> dict[str, str]:
    def field(e: str) -> str:
        return f"CASE WHEN NOT coalesce({null_when}, false) THEN {e} END"

    return {
        "_orig_id": "page_id::VARCHAR",
        "transact_seq": f"{version}::BIGINT",
        "transact_change_timestamp": "page_id * 1000",
        "_class": field("'page'"),
        "_id": field("page_id::VARCHAR"),
        "errorDate": field("page_id * 1000"),
        "errorMessage": field("html"),
        "fileName": field("url"),
    }


ERROR = list(error(1))
ERROR_OP = f"CASE WHEN {PAGE_DELETED} THEN 'D' ELSE 'U' END"
ERRORS = {
    "t": select(error(1), f"pages WHERE {PAGE_OLD}"),
    "s": select({"Op": ERROR_OP, **error(2, PAGE_BROKEN)}, "pages"),
}
