"""Names, labels and catalogue rows that results are compared against."""

from __future__ import annotations

# Fixed values. Feature key -> reader-facing reason; the order decides partial matches.
FEATURE_REASONS = [
    ("sem_grade_delta", "Semester grade decline"),
    ("overall_grade_avg", "Low overall grades"),
    ("curricular_units_1st_sem_grade", "Weak first-semester grades"),
    ("curricular_units_2nd_sem_grade", "Weak second-semester grades"),
    ("previous_qualification_grade", "Weak prior academic record"),
    ("admission_grade", "Lower admission grade"),
    ("sem_approval_delta", "Drop in subject approvals"),
    ("overall_approval_ratio", "Low approval ratio"),
    ("curricular_units_1st_sem_approved", "Low first-semester approvals"),
    ("curricular_units_2nd_sem_approved", "Low second-semester approvals"),
    ("grade_drop_flag", "Recent decline in grades"),
    ("approval_drop_flag", "Recent decline in approvals"),
    ("academic_momentum_band_declining", "Declining academic momentum"),
    ("academic_momentum_band_stable", "Stagnant academic momentum"),
    ("engagement_risk_proxy", "Low learning engagement"),
    ("evaluation_delta", "Drop in evaluation participation"),
    ("engagement_drop_flag", "Recent decline in engagement"),
    ("curricular_units_1st_sem_evaluations", "Low first-semester evaluation activity"),
    ("curricular_units_2nd_sem_evaluations", "Low second-semester evaluation activity"),
    ("curricular_units_1st_sem_without_evaluations", "Missed first-semester evaluations"),
    ("curricular_units_2nd_sem_without_evaluations", "Missed second-semester evaluations"),
    ("sem1_non_evaluated_ratio", "High first-semester non-evaluation ratio"),
    ("sem2_non_evaluated_ratio", "High second-semester non-evaluation ratio"),
    ("absenteeism_index", "High overall absenteeism"),
    ("is_ghosting", "Student disengagement pattern"),
    ("financial_stress_index", "High financial stress"),
    ("financial_segment_high_financial_stress", "Severe financial pressure"),
    ("financial_segment_moderate_financial_stress", "Moderate financial pressure"),
    ("financial_segment_low_financial_stress", "Low financial pressure"),
    ("debtor", "Outstanding financial dues"),
    ("tuition_fees_up_to_date", "Tuition payments not up to date"),
    ("scholarship_holder", "No scholarship support"),
    ("financial_risk_band_high", "High financial risk profile"),
    ("financial_risk_band_medium", "Moderate financial risk profile"),
    ("academic_load_delta", "Change in academic workload"),
    ("curricular_units_1st_sem_enrolled", "First-semester course load pattern"),
    ("curricular_units_2nd_sem_enrolled", "Second-semester course load pattern"),
    ("total_approved_units", "Low total approved units"),
    ("age_at_enrollment", "Age-related study risk pattern"),
    ("course", "Course-level dropout pattern"),
    ("application_mode", "Admission pathway risk pattern"),
    ("application_order", "Admission preference pattern"),
    ("is_primary_choice", "Not primary choice application"),
    ("daytime_evening_attendance", "Attendance schedule pattern"),
    ("marital_status", "Personal background pattern"),
    ("gender", "Gender-linked risk pattern"),
    ("nacionality", "Nationality-linked risk pattern"),
    ("international", "International student adjustment pattern"),
    ("displaced", "Student displacement background"),
    ("educational_special_needs", "Special educational support need"),
    ("previous_qualification", "Prior qualification pathway"),
    ("mothers_qualification", "Mother education background"),
    ("fathers_qualification", "Father education background"),
    ("mothers_occupation", "Mother occupation background"),
    ("fathers_occupation", "Father occupation background"),
    ("course_rigor_score", "Enrolled in high-rigor course"),
    ("grade_deflation_flag", "Course grade deflation pattern"),
    ("admission_gap", "Performance below course average"),
    ("competitive_density", "High-competition course environment"),
    ("unemployment_rate", "High unemployment environment"),
    ("inflation_rate", "Inflation-related stress environment"),
    ("gdp", "Economic environment pattern"),
]

# Fixed values. Placeholders for "no mapped reason".
OTHER_REASON = "Other model risk signal"
OTHER_FEATURE = "other_model_signal"

# Fixed values. Attributes that are audited but never trained on or shown as a reason.
SENSITIVE_FEATURES = [
    "gender",
    "nacionality",
    "marital_status",
    "age_at_enrollment",
    "international",
    "displaced",
    "educational_special_needs",
    "mothers_qualification",
    "fathers_qualification",
    "mothers_occupation",
    "fathers_occupation",
]

# Fixed values. Reasons grouped by the domain that an action belongs to.
FINANCIAL_REASONS = [
    "High financial stress",
    "Severe financial pressure",
    "Moderate financial pressure",
    "Outstanding financial dues",
    "Tuition payments not up to date",
    "No scholarship support",
    "High financial risk profile",
    "Moderate financial risk profile",
]
ACADEMIC_REASONS = [
    "Semester grade decline",
    "Low overall grades",
    "Weak first-semester grades",
    "Weak second-semester grades",
    "Weak prior academic record",
    "Lower admission grade",
    "Drop in subject approvals",
    "Low approval ratio",
    "Low first-semester approvals",
    "Low second-semester approvals",
    "Recent decline in grades",
    "Recent decline in approvals",
    "Declining academic momentum",
    "Stagnant academic momentum",
    "Low total approved units",
    "Performance below course average",
]
ENGAGEMENT_REASONS = [
    "Low learning engagement",
    "Drop in evaluation participation",
    "Recent decline in engagement",
    "Low first-semester evaluation activity",
    "Low second-semester evaluation activity",
    "Missed first-semester evaluations",
    "Missed second-semester evaluations",
    "High first-semester non-evaluation ratio",
    "High second-semester non-evaluation ratio",
    "High overall absenteeism",
    "Student disengagement pattern",
]
CONTEXT_REASONS = [
    "Enrolled in high-rigor course",
    "Course grade deflation pattern",
    "High-competition course environment",
    "High unemployment environment",
    "Inflation-related stress environment",
    "Economic environment pattern",
    "Change in academic workload",
    "First-semester course load pattern",
    "Second-semester course load pattern",
]
FIRST_GENERATION_REASONS = [
    "Mother education background",
    "Father education background",
    "Mother occupation background",
    "Father occupation background",
    "Prior qualification pathway",
]
TOUGH_COURSE_REASONS = [
    "Enrolled in high-rigor course",
    "Course grade deflation pattern",
    "High-competition course environment",
    "Course-level dropout pattern",
    "Performance below course average",
]

# Fixed values. Reason groups of the five-outcome rule set.
BASIC_FINANCIAL_REASONS = [
    "High financial stress",
    "Severe financial pressure",
    "Outstanding financial dues",
    "Tuition payments not up to date",
    "No scholarship support",
]
BASIC_ACADEMIC_REASONS = [
    "Semester grade decline",
    "Low overall grades",
    "Weak first-semester grades",
    "Weak second-semester grades",
    "Drop in subject approvals",
    "Low approval ratio",
    "Low first-semester approvals",
    "Low second-semester approvals",
    "Declining academic momentum",
]
BASIC_ENGAGEMENT_REASONS = [
    "Low learning engagement",
    "Drop in evaluation participation",
    "Recent decline in engagement",
    "Missed first-semester evaluations",
    "Missed second-semester evaluations",
    "High overall absenteeism",
    "Student disengagement pattern",
]

# Fixed values. Past interventions: type, success rate, average cost, stress level, risk threshold,
# description, category.
INTERVENTIONS = [
    ("emergency_grant", 0.73, 500.0, 2, 0.75, "Immediate $500 grant for tuition/books", "financial"),
    ("work_study_placement", 0.68, 200.0, 2, 0.65, "Campus job placement for 10hrs/week", "financial"),
    ("scholarship_application_help", 0.61, 50.0, 1, 0.50, "Assisted scholarship search and applications", "financial"),
    ("payment_plan_restructure", 0.58, 100.0, 2, 0.70, "Flexible tuition payment plans", "financial"),
    ("intensive_tutoring", 0.68, 300.0, 1, 0.60, "3x weekly tutoring in struggling subjects", "academic"),
    ("study_skills_workshop", 0.55, 150.0, 1, 0.40, "Time management & exam prep workshops", "academic"),
    ("course_load_reduction", 0.71, 0.0, 1, 0.80, "Reduce from 6 to 4 units per semester", "academic"),
    ("supplemental_instruction", 0.64, 200.0, 1, 0.55, "Peer-led group study sessions", "academic"),
    ("professor_office_hours", 0.52, 0.0, 0, 0.30, "Encouraged regular office hour attendance", "academic"),
    ("peer_mentorship", 0.61, 100.0, 1, 0.55, "Match with successful upperclassman", "engagement"),
    ("counseling_services", 0.59, 250.0, 2, 0.75, "Mental health counseling & wellness support", "engagement"),
    ("academic_coaching", 0.63, 400.0, 1, 0.65, "Weekly 1-on-1 with academic success coach", "engagement"),
    ("student_community_group", 0.49, 50.0, 0, 0.45, "Join student clubs/organizations", "engagement"),
    ("comprehensive_support_package", 0.78, 1200.0, 2, 0.85, "Grant + tutoring + counseling combo", "multi"),
    ("early_alert_system", 0.44, 0.0, 0, 0.40, "Automated email alerts to at-risk students", "multi"),
    ("math_bootcamp", 0.66, 350.0, 1, 0.70, "Intensive pre-semester math prep", "academic"),
    ("stem_learning_community", 0.72, 500.0, 1, 0.80, "Cohort-based support for STEM majors", "academic"),
]
INTERVENTION_SCHEMA = (
    "intervention_type string, success_rate double, avg_cost double, financial_stress_level int, "
    "risk_score_threshold double, description string, category string"
)
