"""Domain settings: which codes mean what, per deployment.

A ``Domain`` bundles the lookup values the composite jobs need. Two are
defined: the township model (values fixed by the incentive study this engine
reproduces) and the mapping used for the TPC-H-like driver tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Domain:
    district_labels: dict[str, list[str]]          # label -> district codes (ordered)
    other_label: str                                # label for unknown districts
    class_codes: dict[str, str]                     # raw class text -> rate class
    rate_aliases: dict[str, str]                    # alias district -> source district
    gated_fund: str                                 # fund that applies to listed districts only
    gated_districts: list[str]
    excluded_pairs: dict[str, list[str]]            # fund -> municipalities where it does not apply
    funds: dict[str, str] = field(default_factory=lambda: {
        "General": "GeneralRate", "Fire": "FireRate", "Road": "RoadRate"})
    default_class: str = "ResAgr"
    total_rate: str = "TotalTownshipMillage"


# --- Fixed values: township study (must equal the study's tables) ----------
# District code -> municipality, in this order; anything else is "Other".
#   170, 171 -> Jefferson Unincorporated
#   027      -> Gahanna
#   067      -> Reynoldsburg
#   175      -> Columbus
# Tax rate type -> property class: "Res/Ag" -> ResAgr, "Com/Ind" -> ComInd.
# District 171 uses the rates of district 170.
# The Road fund applies to districts 170 and 171 only, and Road rows are
# dropped for Gahanna, Reynoldsburg and Columbus.
# Abatements are rated with class ResAgr.
# Township scope filter value: "JEFFERSON TWP".
# Triennial years of the trend notebooks: 2014, 2017, 2020, 2023.
# Trend district codes (no leading zeros): 170, 171, 175, 27, 67.
# Assessment ratio: 0.35.
TOWNSHIP = Domain(
    district_labels={
        "Jefferson Unincorporated": ["170", "171"],
        "Gahanna": ["027"],
        "Reynoldsburg": ["067"],
        "Columbus": ["175"],
    },
    other_label="Other",
    class_codes={"Res/Ag": "ResAgr", "Com/Ind": "ComInd"},
    rate_aliases={"171": "170"},
    gated_fund="Road",
    gated_districts=["170", "171"],
    excluded_pairs={"Road": ["Gahanna", "Reynoldsburg", "Columbus"]},
    default_class="ResAgr",
)
TOWNSHIP_SCOPE = "JEFFERSON TWP"
TOWNSHIP_TREND_YEARS = [2014, 2017, 2020, 2023]
TOWNSHIP_TREND_DISTRICTS = [170, 171, 175, 27, 67]
ASSESSMENT_RATIO = 0.35

# --- Driver tables (TPC-H-like) ---------------------------------------------
# District = supplier/customer nation key padded to 3 digits.
# 000, 001, 002 -> Core (the gated Road fund applies there), 003 -> B,
# 024 -> C, anything else -> Other. Return flag A -> class A, N -> class N,
# R -> no class (never rated). Nation 24 has no rates of its own and uses
# those of nation 23. Road is dropped for B and C.
DRIVER = Domain(
    district_labels={"Core": ["000", "001", "002"], "B": ["003"], "C": ["024"]},
    other_label="Other",
    class_codes={"A": "A", "N": "N"},
    rate_aliases={"024": "023"},
    gated_fund="Road",
    gated_districts=["000", "001", "002"],
    excluded_pairs={"Road": ["B", "C"]},
    default_class="A",
)
