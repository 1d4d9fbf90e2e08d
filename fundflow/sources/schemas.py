"""Column types of the study's files: read as text (bronze), typed on demand (silver).

``"number"`` marks decorated numeric text ('$1,234.50') that is parsed rather
than cast. Columns not listed stay text.
"""

from __future__ import annotations

# Abatement detail columns and their types, in file order.
ABATEMENT_TYPES: dict[str, str] = {
    "TaxYear": "int", "ParcelNumber": "string", "AbatedLUC": "string", "OwnerName1": "string",
    "OwnerName2": "string", "AbatementTotal": "double", "CaseType": "string",
    "StartYear": "int", "EndYear": "int", "Term": "string", "AbatementType": "string",
    "IncentiveDistrict": "string", "AbatementStatus": "string", "Library": "string",
    "JNVS": "string", "ParkDist": "string", "CityVillage": "string", "Township": "string",
    "School": "string", "ForegoneCountyGen": "double", "ForegoneChildren": "double",
    "ForegoneADMH": "double", "ForegoneFCBDD": "double", "ForegoneParks": "double",
    "ForegoneZoo": "double", "ForegoneSenior": "double", "ForegoneLibrary": "double",
    "ForegoneJNVS": "double", "ForegoneParkDist": "double", "ForegoneCityVillage": "double",
    "ForegoneTownship": "double", "ForegoneSchools": "double", "ForegoneCSCC": "double",
    "ForegoneTotal": "double", "TotalAppraisedValue": "double", "SourceFile": "string",
}

# TIF detail columns the study uses (the full file has more).
TIF_TYPES: dict[str, str] = {
    "TaxYear": "int", "ParcelNumber": "string", "Township": "string", "TaxDistrict": "string",
    "TaxRateType": "string", "DivertedTownship": "double", "DivertedCountyGen": "double",
    "DivertedChildren": "double", "DivertedADMH": "double", "DivertedFCBDD": "double",
    "DivertedParks": "double", "DivertedZoo": "double", "DivertedSenior": "double",
    "DivertedCityVillage": "number", "DivertedLibrary": "number",
    "AppraisedTotal": "double", "AssessedTotal": "double", "SourceFile": "string",
}

# Rate table columns.
RATE_TYPES: dict[str, str] = {
    "TaxYear": "int", "Municipality": "string", "TaxDistrict": "string",
    "PropertyClass": "string", "GeneralRate": "double", "FireRate": "double",
    "RoadRate": "double", "TotalTownshipMillage": "double",
}


def present(types: dict[str, str], columns, skip_strings: bool = True) -> dict[str, str]:
    """The typed columns of ``types`` that a DataFrame actually has."""
    cols = set(columns)
    return {c: t for c, t in types.items() if c in cols and not (skip_strings and t == "string")}
