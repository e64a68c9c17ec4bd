"""The four collections of the feed.

Landing directory, buckets and merge options can be set with `SPEC.with_(...)`.
"""

from __future__ import annotations

from tidemark.functions.docs import DATE, FLAG, LONG, OID, TEXT, list_of, record
from tidemark.plans.spec import CollectionSpec

# The document fields of each collection, in table order, with the types and
# the spelling the feed has.
REPORT_FIELDS = record(
    _class=TEXT,
    _id=TEXT,
    completedDate=DATE,
    ehr=TEXT,
    fromDate=DATE,
    location=TEXT,
    message=TEXT,
    npi=TEXT,
    numOfRetries=LONG,
    orginalReportId=TEXT,
    patients=list_of(_id=TEXT, numOfRetries=LONG, status=TEXT),
    physician=TEXT,
    practice=TEXT,
    priority=TEXT,
    sentToRPATime=DATE,
    singleThreaded=FLAG,
    status=TEXT,
    study=TEXT,
    toDate=DATE,
    type=TEXT,
    uploadTime=DATE,
    practiceId=LONG,
    completedTime=DATE,
)

UPLOAD_FIELDS = record(
    _class=TEXT,
    _id=TEXT,
    ehr=TEXT,
    files=list_of(fileName=TEXT, inputType=TEXT),
    fromDate=DATE,
    location=TEXT,
    npi=TEXT,
    physician=TEXT,
    practice=TEXT,
    priority=TEXT,
    study=TEXT,
    toDate=DATE,
    type=TEXT,
    uploadId=TEXT,
    uploadTime=DATE,
)

UPLOAD_CHANGE_FIELDS = record(
    _class=TEXT,
    _id=TEXT,
    automatedStatus=TEXT,
    dobFormat=TEXT,
    ehr=TEXT,
    fileName=TEXT,
    fromDate=DATE,
    inputType=TEXT,
    isLocked=FLAG,
    isQueued=FLAG,
    isSingleThreaded=FLAG,
    location=TEXT,
    message=TEXT,
    npi=TEXT,
    physician=TEXT,
    physicianSpecialty=TEXT,
    practice=TEXT,
    practiceId=TEXT,
    priority=TEXT,
    study=TEXT,
    toDate=DATE,
    type=TEXT,
    uploadId=TEXT,
    uploadStatus=TEXT,
    uploadTime=DATE,
)

ACCESS_FIELDS = record(
    _class=TEXT,
    _id=OID,
    audit=list_of(audit=TEXT, date=DATE, newValue=TEXT, originalValue=TEXT, reportId=TEXT, user=TEXT),
    ehr=TEXT,
    isSuspended=FLAG,
    practice=TEXT,
    practiceId=TEXT,
)

ERROR_FIELDS = record(
    _class=TEXT,
    _id=OID,
    errorDate=DATE,
    errorMessage=TEXT,
    fileName=TEXT,
)

REPORTS = CollectionSpec(
    name="reports",
    doc_schema=REPORT_FIELDS,
    keys=("_id", "patient__id"),
    array="patients",
    child_fields=("_id", "numOfRetries", "status"),
    child_prefix="patient_",
    unwrap=("completedTime",),
)

UPLOADS = CollectionSpec(
    name="uploads",
    doc_schema=UPLOAD_FIELDS,
    change_schema=UPLOAD_CHANGE_FIELDS,
    keys=("_id", "fileName"),
    array="files",
    child_fields=("fileName", "inputType"),
    flatten_changes=False,
)

ACCESS = CollectionSpec(
    name="access",
    doc_schema=ACCESS_FIELDS,
    keys=("_id", "audit.reportId"),
    array="audit",
    child_fields=("audit", "date", "newValue", "originalValue", "reportId", "user"),
    child_prefix="audit.",
)

ERRORS = CollectionSpec(name="errors", doc_schema=ERROR_FIELDS, keys=("_id",))

COLLECTIONS = (REPORTS, UPLOADS, ACCESS, ERRORS)
