"""Labels for coded fields, as built-in column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Codes and the labels shown for them, spelled as published.
AMENDMENT = {"N": "New", "A": "Amendment", "T": "Termination"}
DESIGNATION = {
    "A": "Authorized by Candidate",
    "B": "Lobbyist/Registrant PAC",
    "D": "Leadership PAC",
    "J": "Joint Fundrasier",
    "P": "Principal Campaign Committee of the Candidate",
    "U": "Unauthorized",
}
ORGANIZATION = {
    "C": "Administratively Terminated",
    "L": "Membership Organization",
    "T": "Trade Association",
    "V": "Cooperative",
    "W": "Cooperative w/o Capital Stock",
}
INCUMBENCY = {"I": "Incumbent", "C": "Challenger", "O": "Open Seat"}
OFFICE = {"H": "House", "S": "Senate", "P": "President"}
NO_CATEGORY = "Other"


def label(code: Column, labels: dict[str, str], keep_unknown: bool = True) -> Column:
    """The label of a code; an unknown code stays as it is, or becomes null."""
    (first, first_text), *others = labels.items()
    shown = F.when(code == first, first_text)
    for known, text in others:
        shown = shown.when(code == known, text)
    return shown.otherwise(code) if keep_unknown else shown


def or_other(category: Column) -> Column:
    return F.coalesce(category, F.lit(NO_CATEGORY))


def district_label(state: Column, district: Column) -> Column:
    """State and district in one text; null when either part is missing."""
    return F.concat(state, district)


def zip5(zip_code: Column) -> Column:
    return F.left(zip_code, F.lit(5))
