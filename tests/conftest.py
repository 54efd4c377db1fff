from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from studylake.schemas import RAW_HEADERS  # noqa: E402
from studylake.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[*]", shuffle_partitions=8, app_name="studylake-tests")
    yield s
    s.stop()


# Six rows, one case or more of each cleaning rule; counts are derived by hand
# in test_cleaning.py. Columns are named as in the schema.
SAMPLE = [
    dict(org_name="Nordlund Clinic", org_class="INDUSTRY", responsible_party="SPONSOR", full_title="Long 0",
         overall_status="RECRUITING", start_date="1949-12-31", standard_age="CHILD",
         conditions="Asthma, Eczema, Rhinitis, Cough", primary_purpose="TREATMENT", interventions="Saline",
         intervention_description="..", study_type="INTERVENTIONAL", phases="PHASE1", outcome_measure="Pain",
         mesh="Lung Diseases, Skin"),
    dict(org_name="Bayview Trials", org_class="NETWORK", responsible_party="SPONSOR", full_title="Long 1",
         overall_status="COMPLETED", start_date="2011-02-28", standard_age="ADULT OLDER_ADULT", conditions="Gout",
         primary_purpose="DIAGNOSTIC", interventions="Dose X, Dose Y, Dose Z", intervention_description="D1",
         study_type="OBSERVATIONAL", phases="PHASE2, PHASE3", outcome_measure="Weight", mesh="Joint Diseases"),
    dict(org_name="Nordlund Clinic", org_class="INDUSTRY", responsible_party="SPONSOR_INVESTIGATOR", full_title="None",
         overall_status="WITHDRAWN", start_date="2015-09", standard_age="  CHILD  ADULT ",
         conditions="Migraine, , Vertigo", primary_purpose="SCREENING", interventions="Missing",
         intervention_description="D2", study_type="None", phases="No phases listed", outcome_measure="Sleep", mesh=None),
    dict(org_name="Missing", org_class="INDIV", responsible_party="SPONSOR", full_title="Long 3",
         overall_status="COMPLETED", start_date="2003-07-01", standard_age="NA", conditions="Anemia",
         primary_purpose="not applicable", interventions="Yoga", intervention_description="D3",
         study_type="INTERVENTIONAL", phases="PHASE4", outcome_measure=None, mesh="Not Available"),
    dict(org_name="Nordlund Clinic", org_class="n/a", responsible_party="--", full_title="Long 4",
         overall_status="SUSPENDED", start_date="NULL", standard_age="OLDER_ADULT", conditions="missing",
         primary_purpose="PREVENTION", interventions="Diet, Walk", intervention_description="D4",
         study_type="INTERVENTIONAL", phases=None, outcome_measure="Recall", mesh="Mind"),
    dict(org_name="Ostara Labs", org_class="INDUSTRY", responsible_party="SPONSOR", full_title=None,
         overall_status="unknown", start_date="1999-10", standard_age="ADULT", conditions="Fever",
         primary_purpose="TREATMENT", interventions="Tea", intervention_description="D5",
         study_type="EXPANDED_ACCESS", phases="NA", outcome_measure="-", mesh="Body, Soul"),
]


@pytest.fixture()
def sample_raw(spark):
    columns = list(RAW_HEADERS)
    rows = [(i, *[f"T{i}" if c == "brief_title" else r[c] for c in columns]) for i, r in enumerate(SAMPLE)]
    return spark.createDataFrame(rows, "source_row_index long, " + ", ".join(f"{c} string" for c in columns))
