"""Masking of private identifiers in text columns, as regular-expression replacements over whole texts."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as an identifier, and what replaces it.
BUCKET = r"(?iu)(?<![a-z0-9-])[a-z0-9][a-z0-9-]*?-(bronze|silver|gold|athenaresults)bucket-[a-z0-9]+"
BUCKET_ROLES = {"bronze": "bronze", "silver": "silver", "gold": "gold", "athenaresults": "athena-results"}
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
ARN = r"""arn:aws[a-z-]*:[^\s"']+"""
ACCOUNT = r"(?<![0-9])[0-9]{12}(?![0-9])"
VERSION_FIELD = r"""("?VersionId"?\s*[:=]\s*"?)([^\s",}]+)"""
VERSION_ID = (r"(?<![A-Za-z0-9._+/-])(?=[A-Za-z0-9._+]*[0-9])(?=[A-Za-z0-9._+]*[A-Za-z])"
              r"[A-Za-z0-9._+]{32}(?![A-Za-z0-9._+-])")
VISIT_FIELD = r"""("visit_id"\s*:\s*)("[^"]*"|-?[0-9.]+)"""
VISIT_LABEL = "visit A"

# Stands around a bucket's role between the two replacement steps; taken out of the text before the first one.
_MARK = "\ue000"


# The same addresses, looked for where a name begins (or the last match ended) and not again at each of its letters.
_EMAIL_FROM_START = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


def _where(text: Column, has: Callable[[Column], Column], masked: Callable[[Column], Column]) -> Column:
    """Run a costly pattern only over texts that hold a plain part of it; searching for that part is far cheaper. The text,
    often the outcome of another replacement, is made once however often it is looked at."""
    return F.transform(F.array(text), lambda once: F.when(has(once), masked(once)).otherwise(once))[0]


def mask_buckets(text: Column) -> Column:
    """Generated bucket names become their role. One pass finds them, so a name is never matched twice."""
    def masked(once: Column) -> Column:
        found = F.regexp_replace(F.translate(once, _MARK, ""), BUCKET, f"{_MARK}$1{_MARK}")
        for role, label in BUCKET_ROLES.items():
            found = F.regexp_replace(found, f"(?iu){_MARK}{role}{_MARK}", f"<{label}-bucket>")
        return found

    return _where(text, lambda once: F.lower(once).contains("bucket-"), masked)


def mask_arns(text: Column) -> Column:
    return _where(text, lambda once: once.contains("arn:aws"), lambda once: F.regexp_replace(once, ARN, "<arn>"))


def mask_emails(text: Column) -> Column:
    return _where(text, lambda once: once.contains("@"), lambda once: F.regexp_replace(once, _EMAIL_FROM_START, "<email>"))


def mask_accounts(text: Column) -> Column:
    return _where(text, lambda once: once.rlike("[0-9]{12}"), lambda once: F.regexp_replace(once, ACCOUNT, "<account-id>"))


def mask_text(text: Column | str) -> Column:
    """Buckets, then ARNs, then e-mail addresses, then account ids."""
    text = F.col(text) if isinstance(text, str) else text
    return mask_accounts(mask_emails(mask_arns(mask_buckets(text))))


def mask_versions(text: Column) -> Column:
    labelled = F.regexp_replace(text, VERSION_FIELD, "$1<version-id>")
    return F.regexp_replace(labelled, VERSION_ID, "<version-id>")


def mask_visit(text: Column | str, visit: Column | str) -> Column:
    """Everything above, and the visit part of a click id of the given visit."""
    text = F.col(text) if isinstance(text, str) else text
    visit = F.col(visit) if isinstance(visit, str) else visit
    masked = mask_versions(mask_text(text))
    of_visit = F.concat(F.lit("uci553-"), visit.cast("string"), F.lit("-"))
    return F.replace(masked, of_visit, F.lit(f"uci553-{VISIT_LABEL}-"))


def mask_visit_fields(json_text: Column | str) -> Column:
    """In JSON text, the label instead of every value of a field that carries a visit id; a null stays."""
    json_text = F.col(json_text) if isinstance(json_text, str) else json_text
    return F.regexp_replace(json_text, VISIT_FIELD, f'$1"{VISIT_LABEL}"')
