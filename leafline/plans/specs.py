"""What tells one office from another: levels, event targets, labels and record columns."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Element ids, parameters, event targets and column names of the form protocol.
STATE_FIELDS = {"event_validation": "__EVENTVALIDATION", "view_state": "__VIEWSTATE", "view_state_generator": "__VIEWSTATEGENERATOR"}
SELECT_IDS = {"post": "ddlPostName", "district": "ddlDistrict", "block": "ddlBlok", "panchayat": "ddlPanchayat", "ward": "ddlWard", "pradesik": "ddlPradesik"}
NUMBER_LABEL, STATUS_LABEL, REQUIRED_LABEL = "lblPradesikForMukhiya", "lblReservationStatusForMukhiya", "lblResevationShow"
GRID_ID = "gvVoterListDetails"
TAIL = ("sr_no", "candidate_name", "father_husband_name", "gender", "age", "category", "educ", "mobile_number", "address", "email", "valid_vote", "remarks")
OPTIONAL_CELL = TAIL.index("email")


@dataclass(frozen=True)
class OfficeSpec:
    """targets: the event target that is posted once a node of that level is chosen.

    labels: "optional" reads number and status from two spans, each '' where it is missing; "required"
    reads the status from one that must be there, and the number is the last level's name.
    """

    key: str
    levels: tuple[str, ...]
    targets: tuple[str, ...]
    labels: str
    leaf_sends: tuple[str, ...] = field(default=())

    @property
    def ancestors(self) -> tuple[str, ...]:
        """Levels whose names are columns; a constituency level is the number instead."""
        return tuple(x for x in self.levels if x != "pradesik")

    @property
    def columns(self) -> tuple[str, ...]:
        return (*self.ancestors, "number", "reservation_status", *TAIL)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])


_FOUR, _FIVE = ("post", "district", "block", "panchayat"), ("post", "district", "block", "panchayat", "ward")
# Which target each step posts. The ward list posts the block's, and the labels below a ward the panchayat's.
_TARGETS = {
    "zp": ("ddlPostName", "ddlDistrict", "ddlPradesik"),
    "ps": ("ddlPostName", "ddlDistrict", "ddlBlok", "ddlPradesik"),
    "four": ("ddlPostName", "ddlDistrict", "ddlBlok", "ddlPanchayat"),
    "five": ("ddlPostName", "ddlDistrict", "ddlBlok", "ddlBlok", "ddlPanchayat"),
}
OFFICES = {
    "zp": OfficeSpec("zp", ("post", "district", "pradesik"), _TARGETS["zp"], "required"),
    "ps": OfficeSpec("ps", ("post", "district", "block", "pradesik"), _TARGETS["ps"], "required"),
    "mu": OfficeSpec("mu", _FOUR, _TARGETS["four"], "optional"),
    "sa": OfficeSpec("sa", _FOUR, _TARGETS["four"], "optional"),
    "pa": OfficeSpec("pa", _FIVE, _TARGETS["five"], "optional"),
    "wm": OfficeSpec("wm", _FIVE, _TARGETS["five"], "optional"),
}


@dataclass(frozen=True)
class ResumeSpec:
    """Names from which a run starts, by level; number is the constituency label where that is one.
    An empty name is no constraint."""

    names: dict[str, str] = field(default_factory=dict)
    number: str = ""

    def at(self, level: str) -> str:
        return self.names.get(level, "")

    @property
    def fresh(self) -> bool:
        """Whether a run writes its header anew: nothing but the post is given."""
        return not self.number and not any(v for k, v in self.names.items() if k != "post")
