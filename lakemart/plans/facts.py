"""The fact tables, as DataFrame plans over dimensions.

Each builder takes ``t``, a function from table name to DataFrame. Two habits
keep the large side of a fact from being shuffled more than needed:

- a chain of hops is resolved from its far end, dimension by dimension, so the
  fact meets one flattened dimension instead of every hop;
- a fact whose grain is its base table is numbered on the narrow base rows
  before the lookups, one that fans out is numbered after them.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.operators import bridge
from lakemart.operators.calendar import date_ids, status_ids
from lakemart.operators.keys import dense_keys, unnumbered
from lakemart.operators.lookup import attach, current, lookup_by_candidates, lookup_sk
from lakemart.operators.shape import project_fact, surrogate_key
from lakemart.plans.star import REFERENCES, fact_fields

Tables = Callable[[str], DataFrame]
Numbering = Callable[[DataFrame, Sequence[str], str], DataFrame]


def base_rows(t: Tables, dim: str, columns: Sequence[str]) -> DataFrame:
    """Current rows of a dimension, only the columns the fact reads (if present)."""
    rows = current(t(dim))
    return rows.select(*[c for c in columns if c in rows.columns])


def dg_window(t: Tables, number: Numbering = dense_keys) -> DataFrame:
    rows = base_rows(t, "dim_lpd_dgwindow", ["id", "lpd_dgwindow_sk", "beginning", "ending", "financial_year_id"])
    df = number(rows, ["id"], "dg_window_fact_id").withColumnRenamed("lpd_dgwindow_sk", "dg_window_sk")
    df = date_ids(df, t("dim_date"), {"beginning": "window_open_date_id", "ending": "window_close_date_id"})
    df = lookup_sk(df, t("dim_src_financialyear"), "financial_year_id", "src_financialyear_sk", "financial_year_sk")
    grants = bridge.members_per_parent(
        current(t("dim_lpd_dgwindowindicatorgrant")), "dg_window_id", "lpd_dgwindowindicatorgrant_sk", "grants"
    )
    df = attach(df, grants, "id", {"grants": "dgwindowindicatorgrant_sk"}, nk="dg_window_id")
    return project_fact(df, fact_fields("fact_dg_window"))


def loi_status_history(t: Tables, number: Numbering = dense_keys) -> DataFrame:
    rows = base_rows(
        t, "dim_lpd_loi", ["id", "lpd_loi_sk", "created_at", "date_submitted", "company_id", "dg_window_id"]
    )
    df = number(rows, ["id"], "loi_id").withColumnRenamed("lpd_loi_sk", "loi_sk")
    df = date_ids(df, t("dim_date"), {"created_at": "created_date_id", "date_submitted": "submitted_date_id"})
    children = bridge.members_per_parent(
        current(t("dim_lpd_loiintervention")), "loi_id", "lpd_loiintervention_sk", "sks", count_out="n"
    ).withColumnRenamed("loi_id", "parent")
    df = attach(df, children, "id", {"sks": "intervention_sks", "n": "intervention_count"}, nk="parent")
    df = lookup_sk(df, t("dim_company_company"), "company_id", "company_company_sk", "company_sk")
    df = lookup_sk(df, t("dim_lpd_dgwindow"), "dg_window_id", "lpd_dgwindow_sk", "dg_window_sk")
    return project_fact(df, fact_fields("fact_loi_status_history"))


def intervention(t: Tables, number: Numbering = dense_keys) -> DataFrame:
    indicator_columns = ["indicator_id", "src_indicator_id", "indicator", "indicator_fk"]
    rows = base_rows(
        t,
        "dim_lpd_loiintervention",
        ["id", "lpd_loiintervention_sk", "created_at", "loi_id", "area_id", "sic_code_id", "intervention_id",
         "src_indicator_sk", *indicator_columns],
    )
    df = number(rows, ["id"], "intervention_fact_id")
    df = date_ids(df, t("dim_date"), {"created_at": "intervention_created_date_id"})
    loi = base_rows(t, "dim_lpd_loi", ["id", "lpd_loi_sk", "company_id"])
    loi = lookup_sk(loi, t("dim_company_company"), "company_id", "company_company_sk", "company_sk")
    df = attach(df, loi, "loi_id", {"lpd_loi_sk": "loi_sk", "company_sk": "company_sk"})
    df = lookup_sk(df, t("dim_configurable_suburb"), "area_id", "configurable_suburb_sk", "municipality_sk")
    df = lookup_sk(df, t("dim_src_subsectoractivity"), "sic_code_id", "src_subsectoractivity_sk", "subsector_sk")
    df = lookup_sk(df, t("dim_src_descretionarygrant"), "intervention_id", "src_descretionarygrant_sk", "grant_type_sk")
    df = lookup_by_candidates(df, t("dim_src_indicator"), indicator_columns, "src_indicator_sk", "indicator_sk")
    df = df.withColumnRenamed("lpd_loiintervention_sk", "intervention_sk").withColumn("is_current", F.lit(True))
    return project_fact(df, fact_fields("fact_intervention"))


def vetting(t: Tables, number: Numbering = dense_keys) -> DataFrame:
    df = base_rows(t, "dim_lpd_loivetting", ["id", "lpd_loivetting_sk", "intervention_id", "loi_id"])
    df = df.withColumnRenamed("lpd_loivetting_sk", "vetting_sk")
    df = lookup_sk(df, t("dim_lpd_loiintervention"), "intervention_id", "lpd_loiintervention_sk", "intervention_sk")
    df = lookup_sk(df, t("dim_lpd_loi"), "loi_id", "lpd_loi_sk", "loi_sk")
    risks = bridge.linked_members(
        current(t("dim_lpd_loivettingrisk")), "vetting_id", "risk_id",
        current(t("dim_lpd_vettingrisk")), "lpd_vettingrisk_sk", "sks",
    )
    df = attach(df, risks, "id", {"sks": "vettingrisk_sks"}, nk="vetting_id")
    # Without any known risk the bridge points at the unknown member.
    unknown = F.array(F.lit(0).cast("bigint"))
    df = df.withColumn("vettingrisk_sks", F.when(F.size("vettingrisk_sks") > 0, F.col("vettingrisk_sks")).otherwise(unknown))
    # One row per approval: the fan-out comes last, on rows already complete.
    approvals = current(t("dim_lpd_loivettingapproval"))
    df = attach(df, approvals, "id", {"lpd_loivettingapproval_sk": "vetting_approval_sk"}, nk="vetting_id")
    df = number(df, ["id", "vetting_approval_sk"], "vetting_fact_id")
    return project_fact(df, fact_fields("fact_vetting"))


def appeal(t: Tables, number: Numbering = dense_keys) -> DataFrame:
    rows = base_rows(
        t, "dim_lpd_loiinterventionappeal",
        ["id", "lpd_loiinterventionappeal_sk", "intervention_id", "date_appeal", "status"],
    )
    df = number(rows, ["id"], "appeal_fact_id").withColumnRenamed("lpd_loiinterventionappeal_sk", "appeal_sk")
    interventions = base_rows(t, "dim_lpd_loiintervention", ["id", "lpd_loiintervention_sk", "loi_id"])
    interventions = lookup_sk(interventions, t("dim_lpd_loi"), "loi_id", "lpd_loi_sk", "loi_sk")
    df = attach(
        df, interventions, "intervention_id", {"lpd_loiintervention_sk": "intervention_no", "loi_sk": "loi_no"}
    )
    df = date_ids(df, t("dim_date"), {"date_appeal": "appeal_date"})
    df = status_ids(df, t("dim_status"), "status", "appeal_status", "lpd_loiinterventionappeal")
    return project_fact(df.withColumn("is_current", F.lit(True)), fact_fields("fact_appeal"))


DISBURSEMENT_ROLES = [
    f"{ordinal}_disbursement_id" for ordinal in ("first", "second", "third", "fourth", "fifth", "sixth")
]


def learning_programme(t: Tables, number: Numbering = dense_keys) -> DataFrame:
    df = base_rows(t, "dim_lpd_learningprogrammesla", ["id", "lpd_learningprogrammesla_sk", "learning_programme_id"])
    df = df.withColumnRenamed("lpd_learningprogrammesla_sk", "sla_sk")
    programmes = current(t("dim_lpd_learningprogramme"))
    df = attach(
        df, programmes, "learning_programme_id", {"lpd_learningprogramme_sk": "learning_programme_sk", "id": "_programme"}
    )
    register = bridge.role_array(
        current(t("dim_lpd_learningprogrammecommitmentregister")),
        ["learning_programme_sla_id", "lpd_learningprogrammecommitmentregister_sk"],
        DISBURSEMENT_ROLES,
        current(t("dim_lpd_learningprogrammedisbursement")),
        "lpd_learningprogrammedisbursement_sk",
        "sks",
    )
    df = attach(
        df, register, "id",
        {"lpd_learningprogrammecommitmentregister_sk": "commitmentregister_sk", "sks": "disbursement_sk"},
        nk="learning_programme_sla_id",
    )
    children = {
        "lpd_learningprogrammeaddendum": ("id", "learning_programme_sla_id", "learningprogrammeaddendum_sk"),
        "lpd_learningprogrammewriteback": ("id", "learning_programme_sla_id", "writeback_sk"),
        "lpd_learningprogrammetrainingprovider": ("_programme", "learning_programme_id", "trainingprovider_sk"),
        "lpd_learningprogrammeslalearnerlistrequest": ("id", "learning_programme_sla_id", "slalearnerlistrequest_sk"),
    }
    for source, (key, parent, out) in children.items():
        df = attach(df, current(t(f"dim_{source}")), key, {f"{source}_sk": out}, nk=parent)
    order = ["id", "learningprogrammeaddendum_sk", "commitmentregister_sk", "writeback_sk", "trainingprovider_sk",
             "slalearnerlistrequest_sk"]
    df = number(df, order, "learning_programme_fact_id")
    return project_fact(df, fact_fields("fact_learning_programme"))


def latest_child(children: DataFrame, parent: str, at: str) -> DataFrame:
    """The latest moment per parent: a partial aggregate before the join, so a hot parent is a row per task."""
    return children.where(F.col(parent).isNotNull()).groupBy(parent).agg(F.max(at).alias(at))


def learner(t: Tables) -> DataFrame:
    """Rows of the versioned learner fact, without keys (see ``versioned_upsert``), one per learner programme.

    ``learner_programme_id`` is its durable key; the surrogate key beside it
    moves with the versions of the dimension. Of several placements or
    terminations of a programme the latest counts.
    """
    df = base_rows(
        t, "dim_lpd_learnerprogramme",
        ["id", "lpd_learnerprogramme_sk", "created_at", "date_employed", "learning_programme_id",
         "learning_programme_sla_id", "learner_id"],
    ).withColumnRenamed("lpd_learnerprogramme_sk", "learner_programme_sk")
    placements = current(t("dim_lpd_learnerprogrammeplacement"))
    df = attach(df, latest_child(placements, "learner_programme_id", "created_at"), "id", {"created_at": "_placed"}, nk="learner_programme_id")
    terminations = current(t("dim_lpd_learnerprogrammetermination"))
    df = attach(df, latest_child(terminations, "learner_programme_id", "termination_date"), "id", {"termination_date": "_ended"}, nk="learner_programme_id")
    df = date_ids(
        df, t("dim_date"),
        {"created_at": "contract_date_id", "_placed": "placement_date_id", "_ended": "completion_date_id",
         "date_employed": "employment_date_id"},
    )
    df = lookup_sk(df, t("dim_lpd_learningprogramme"), "learning_programme_id", "lpd_learningprogramme_sk", "learning_programme_sk")
    df = lookup_sk(df, t("dim_lpd_learningprogrammesla"), "learning_programme_sla_id", "lpd_learningprogrammesla_sk", "sla_sk")
    df = lookup_sk(df, t("dim_learner_learner"), "learner_id", "learner_learner_sk", "learner_sk")
    # The null fill of the projection must not give a row without an id the key 0.
    keyed = df.withColumn("learner_programme_id", F.col("id").cast("bigint")).withColumn("_nameless", F.col("id").isNull())
    fields = fact_fields("fact_learner").add("learner_programme_id", "long").add("_nameless", "boolean")
    made = project_fact(keyed, fields)
    return made.withColumn("learner_programme_id", F.when(~F.col("_nameless"), F.col("learner_programme_id"))).drop("_nameless")


def nonfunded_programme(t: Tables, number: Numbering = dense_keys) -> DataFrame:
    rows = base_rows(t, "dim_lpd_nonfundedprogramme", ["id", "lpd_nonfundedprogramme_sk"])
    df = number(rows, ["id"], "nfp_id").withColumnRenamed("lpd_nonfundedprogramme_sk", "nf_sk")
    learners = bridge.members_per_parent(
        current(t("dim_lpd_nonfundedlearnerprogramme")),
        "non_funded_programme_id", "lpd_nonfundedlearnerprogramme_sk", "sks",
    )
    df = attach(df, learners, "id", {"sks": "nf_learners"}, nk="non_funded_programme_id")
    one_of_many = {
        "lpd_nonfundedcompliancecheck": ("nf_id", "nf_cc"),
        "lpd_nonfundedchecklist": ("nf_id", "nf_cl"),
        "lpd_nonfundedprogrammetrainingprovider": ("nf_programme_id", "nf_tp"),
    }
    for source, (parent, out) in one_of_many.items():
        top = bridge.max_member(current(t(f"dim_{source}")), parent, f"{source}_sk", "top")
        df = attach(df, top, "id", {"top": out}, nk=parent)
    return project_fact(df, fact_fields("fact_nonfunded_programme"))


def company(t: Tables, number: Numbering = dense_keys) -> DataFrame:
    rows = base_rows(t, "dim_company_company", ["id", "company_company_sk", "industry_id", "province_id"])
    df = number(rows, ["id"], "company_fact_id").withColumnRenamed("company_company_sk", "company_sk")
    df = lookup_sk(df, t("dim_src_subsectoractivity"), "industry_id", "src_subsectoractivity_sk", "industry_sk")
    df = lookup_sk(df, t("dim_configurable_province"), "province_id", "configurable_province_sk", "province_sk")
    directors = bridge.ordered_members(
        current(t("dim_company_director")), "company_id", "company_director_sk", "created_at", "sks"
    )
    df = attach(df, directors, "id", {"sks": "director_sks"}, nk="company_id")
    return project_fact(df, fact_fields("fact_company"))


def disbursement(t: Tables, number: Numbering = dense_keys) -> DataFrame:
    df = base_rows(
        t, "dim_lpd_learningprogrammedisbursement",
        ["id", "learning_programme_id", "learning_programme_sla_id", "disbursement_id",
         "payment_batch_schedule_id", "grants_admin_id", "date_paid"],
    )
    df = df.withColumn("id", F.col("id").cast("bigint")).withColumnRenamed("id", "learningprogrammedisbursement_id")

    loi = base_rows(t, "dim_lpd_loi", ["id", "company_id", "dg_window_id", "financial_year_id"])
    loi = lookup_sk(loi, t("dim_company_company"), "company_id", "company_company_sk", "company_sk")
    loi = lookup_sk(loi, t("dim_lpd_dgwindow"), "dg_window_id", "lpd_dgwindow_sk", "dg_window_sk")
    loi = lookup_sk(loi, t("dim_src_financialyear"), "financial_year_id", "src_financialyear_sk", "trade_payable_finyear_sk")
    from_loi = ["company_sk", "dg_window_sk", "trade_payable_finyear_sk"]
    interventions = base_rows(t, "dim_lpd_loiintervention", ["id", "loi_id", "indicator_id"])
    interventions = attach(interventions, loi, "loi_id", {c: c for c in from_loi})
    interventions = lookup_sk(interventions, t("dim_src_indicator"), "indicator_id", "src_indicator_sk", "indicator_sk")
    hops = [*from_loi, "indicator_sk"]
    programmes = base_rows(t, "dim_lpd_learningprogramme", ["id", "lpd_learningprogramme_sk", "intervention_id"])
    programmes = attach(programmes, interventions, "intervention_id", {c: c for c in hops})
    df = attach(
        df, programmes, "learning_programme_id",
        {"lpd_learningprogramme_sk": "learningprogramme_sk", **{c: c for c in hops}},
    )
    stages = base_rows(t, "dim_src_discretionarygrantdisbursement", ["id", "src_discretionarygrantdisbursement_sk", "grant_id"])
    stages = lookup_sk(stages, t("dim_src_descretionarygrant"), "grant_id", "src_descretionarygrant_sk", "discretionarygrant_sk")
    df = attach(
        df, stages, "disbursement_id",
        {"src_discretionarygrantdisbursement_sk": "disbursement_stage_sk", "discretionarygrant_sk": "discretionarygrant_sk"},
    )
    df = lookup_sk(df, t("dim_lpd_learningprogrammesla"), "learning_programme_sla_id", "lpd_learningprogrammesla_sk", "sla_sk")
    df = lookup_sk(df, t("dim_finance_paymentbatchschedule"), "payment_batch_schedule_id", "finance_paymentbatchschedule_sk", "payment_batch_sk")
    df = lookup_sk(df, t("dim_accounts_user"), "grants_admin_id", "accounts_user_sk", "grants_admin_user_sk")
    approvals = current(t("dim_lpd_learningprogrammedisbursementapproval"))
    df = attach(df, approvals, "learningprogrammedisbursement_id", {"admin_date_signoff": "_approved"}, nk="disbursement_id")
    df = date_ids(df, t("dim_date"), {"date_paid": "scheduled_date_sk", "_approved": "approved_date_sk"})
    df = number(df, ["learningprogrammedisbursement_id", "approved_date_sk"], "learningprogramme_disbursement_fact_id")
    return project_fact(df, fact_fields("fact_learningprogramme_disbursement"))


def _days(start: str, end: str) -> Column:
    return F.datediff(F.to_date(end), F.to_date(start))


# Event statuses that mark the milestones.
APPLICATION_APPROVED, APPLICATION_DELINKED = "Application Approved", "Application Delinked"
SUBMISSION_APPROVED, SUBMISSION_CLOSED = "Approved", "Closed"


def _company_fact_ids(t: Tables) -> DataFrame:
    """``(id, company_fact_id)`` of current companies present in the company fact."""
    companies = current(t("dim_company_company")).select("id", "company_company_sk")
    facts = t("fact_company").select(F.col("company_sk").alias("_sk"), "company_fact_id")
    return companies.join(facts, F.col("company_company_sk") == F.col("_sk"), "inner").select("id", "company_fact_id")


def sdf_application(t: Tables) -> DataFrame:
    moments = bridge.milestones(
        current(t("dim_ssp_sdfregistrationtracker")),
        ["company_wsp_submission_id", "sdf_id"], "status", "created_at", "submitted",
        {APPLICATION_APPROVED: "approved", APPLICATION_DELINKED: "delinked"},
    )
    submissions = base_rows(t, "dim_ssp_companywspsubmission", ["id", "company_id"])
    companies = _company_fact_ids(t).withColumnRenamed("id", "_company")
    submissions = submissions.join(companies, F.col("company_id") == F.col("_company"), "inner")
    df = moments.join(
        submissions.select(F.col("id").alias("_id"), "company_fact_id"),
        F.col("company_wsp_submission_id") == F.col("_id"), "inner",
    )
    df = lookup_sk(df, t("dim_company_sdf"), "sdf_id", "company_sdf_sk", "_sdf_sk")
    df = date_ids(
        df, t("dim_date"),
        {"submitted": "submissiondate_id", "approved": "approvaldate_id", "delinked": "delinkeddate_id"},
    )
    approved, delinked = F.col("approved").isNotNull(), F.col("delinked").isNotNull()
    return df.select(
        F.col("company_wsp_submission_id").alias("deg_wsp_submission_id"),
        F.col("company_fact_id").alias("company_id"),
        F.col("_sdf_sk").alias("sdf_id"),
        "submissiondate_id",
        "approvaldate_id",
        "delinkeddate_id",
        F.lit(1).alias("m_sdf_application_count"),
        F.when(approved, _days("submitted", "approved")).otherwise(0).alias("m_days_to_approval"),
        F.when(approved & delinked, _days("approved", "delinked")).otherwise(0).alias("m_days_to_delink"),
    )


def wsp_submission(t: Tables) -> DataFrame:
    # One aggregate answers both "has an audit row" and "latest of each status".
    audits = bridge.latest_per_status(
        current(t("dim_ssp_wspsubmissionaudittracker")),
        ["company_wsp_submission_id"], "status", "created_at",
        {SUBMISSION_APPROVED: "approved", SUBMISSION_CLOSED: "closed"},
    )
    df = base_rows(
        t, "dim_ssp_companywspsubmission",
        ["id", "ssp_companywspsubmission_sk", "company_id", "sdf_id", "wsp_period_id", "date_wsp_submitted"],
    )
    df = df.join(audits, F.col("id") == F.col("company_wsp_submission_id"), "inner")
    df = attach(df, _company_fact_ids(t), "company_id", {"company_fact_id": "company_fact_id"})
    df = lookup_sk(df, t("dim_company_sdf"), "sdf_id", "company_sdf_sk", "company_sdf_sk")
    df = lookup_sk(df, t("dim_ssp_wspperiod"), "wsp_period_id", "ssp_wspperiod_sk", "wsp_period_sk")
    df = date_ids(
        df, t("dim_date"),
        {"date_wsp_submitted": "submitted_date_id", "approved": "approved_date_id", "closed": "closed_date_id"},
    )
    approval_days = F.when(F.col("approved").isNotNull(), _days("date_wsp_submitted", "approved")).otherwise(0)
    return df.select(
        F.col("ssp_companywspsubmission_sk").alias("wsp_submission_sk"),
        F.col("id").alias("submission_natural_id"),
        "company_fact_id",
        "company_sdf_sk",
        "wsp_period_sk",
        "submitted_date_id",
        "approved_date_id",
        "closed_date_id",
        approval_days.alias("approval_days"),
    )


def role_dates(t: Tables, fact: str, dim: str, ids: dict[str, str], dates: dict[str, str]) -> DataFrame:
    """Ids renamed by ``ids`` and resolved to the surrogate keys that the fact declares, dates by ``dates``.

    Unknown and missing members give 0.
    """
    own = surrogate_key(dim.removeprefix("dim_"))
    df = base_rows(t, dim, [*ids, own, *dates])
    for column, out in ids.items():
        target, key = REFERENCES[fact][out]
        if target == dim and column == "id":
            df = df.withColumn(f"_sk_{out}", F.col(own))
        else:
            df = lookup_sk(df, t(target), column, key, f"_sk_{out}")
    keys = [F.coalesce(F.col(f"_sk_{out}").cast("bigint"), F.lit(0).cast("bigint")).alias(out) for out in ids.values()]
    return date_ids(df, t("dim_date"), dates).select(*keys, *dates.values())


def certify_learners(t: Tables) -> DataFrame:
    return role_dates(
        t,
        "fact_certifylearners",
        "dim_etqa_trainingprogrammelearner",
        {"learner_id": "learner_id", "id": "etqa_trainingprogrammelearner_id", "disability_id": "disability_id",
         "gender_id": "gender_id", "race_id": "race_id",
         "training_provider_programme_id": "training_provider_programme_id"},
        {"date_learner_entered": "date_learer_entered_id", "programme_start_date": "date_programme_start_id",
         "certification_date": "certification_date_id",
         "training_programme_start_date": "training_programme_start_date_id",
         "training_programme_end_date": "training_programme_end_date_id"},
    )


def assessor_moderator(t: Tables) -> DataFrame:
    same = ("disability_id", "gender_id", "race_id", "training_provider_id", "application_id",
            "training_provider_application_id", "unit_standard_application_id", "unit_standard_id")
    return role_dates(
        t,
        "fact_assessor_moderator",
        "dim_etqa_assessormoderator",
        {"id": "assessor_moderator_id", **{c: c for c in same}},
        {"assessor_approve_date": "assessor_approve_date_id", "assessor_end_date": "assessor_end_date_id",
         "moderator_approve_date": "moderator_approve_date_id", "moderator_end_date": "moderator_end_date_id",
         "application_created_at": "application_created_at_id"},
    )


# In build order: the company fact comes before the facts that refer to it.
BUILDERS: dict[str, Callable[[Tables], DataFrame]] = {
    "fact_dg_window": dg_window,
    "fact_loi_status_history": loi_status_history,
    "fact_company": company,
    "fact_intervention": intervention,
    "fact_vetting": vetting,
    "fact_appeal": appeal,
    "fact_learning_programme": learning_programme,
    "fact_nonfunded_programme": nonfunded_programme,
    "fact_learningprogramme_disbursement": disbursement,
    "fact_learner": learner,
    "fact_certifylearners": certify_learners,
    "fact_assessor_moderator": assessor_moderator,
    "fact_sdf_application": sdf_application,
    "fact_wsp_submission": wsp_submission,
}


def unkeyed(name: str, t: Tables) -> DataFrame:
    """Fact ``name`` with all its rows and columns, but 0 for its own key.

    For checks that do not read that key: no row is sorted and written to be numbered.
    """
    builder = BUILDERS[name]
    return builder(t, number=unnumbered) if "number" in inspect.signature(builder).parameters else builder(t)
