"""Business constants that results depend on, stated as they are."""

# --- reject reasons ---------------------------------------------------------
# First failing rule wins, in this order.
LEAD_REJECT_REASONS = (
    "NULL_FIRST_NAME",
    "NULL_LAST_NAME",
    "NULL_EMAIL",
    "NULL_PHONE_NUMBER",
    "INVALID_FILE_DATE",
)
NO_CONSENT = "NO_CONSENT"

# Reasons that mean a blocked send, not a refused lead.
SUPPRESSION_REASONS = ("SUPPRESSED_PROSPECT", "FATAL_ERROR", "SUPPRESSED")

# Table names written to the reject log.
MASTER_TABLE = "PHI_PROSPECT_MASTER"
SILVER_TABLE = "SLV_PROSPECT_MASTER"
ENGAGEMENT_TABLE = "FACT_SFMC_ENGAGEMENT"

# Spellings of a set flag.
TRUTHY_FLAGS = ("YES", "Y", "TRUE", "1")

# --- identifiers and sentinels ----------------------------------------------
# Master id format and first sequence number.
MASTER_ID_FORMAT = "FIP%010d"
FIRST_MASTER_NUMBER = 801
OPEN_END = "9999-12-31"
NULL_DATE = "1900-01-01"

# --- default parameters -----------------------------------------------------
# Default inclusive date range.
START_DATE = "2020-01-01"
END_DATE = "2099-12-31"

# --- event types ------------------------------------------------------------
# Fixed values: (event type, category, positive signal).
ENGAGEMENT_TYPES = (
    ("SENT", "Delivery", True),
    ("OPEN", "Engagement", True),
    ("CLICK", "Engagement", True),
    ("BOUNCE", "Negative", False),
    ("UNSUBSCRIBE", "Negative", False),
    ("SPAM", "Negative", False),
    ("SUPPRESSED", None, None),
)

# --- journeys ---------------------------------------------------------------
# Fixed values: (stage number, journey code, journey name, stage name,
# column stem of the wide journey table, label in the stage summary,
# label in the last-stage report).
STAGES = (
    (1, "J01_Welcome", "Prospect Welcome Journey", "Welcome Email",
     "welcomejourney_welcomeemail",
     "Stage 1 — Welcome Email (J01)", "Stage 1 — Welcome Email"),
    (2, "J01_Welcome", "Prospect Welcome Journey", "Education Email",
     "welcomejourney_educationemail",
     "Stage 2 — Education Email (J01)", "Stage 2 — Education Email"),
    (3, "J02_Nurture", "Prospect Nurture Journey", "Education Email 1",
     "nurturejourney_educationemail1",
     "Stage 3 — Nurture Edu Email 1 (J02)", "Stage 3 — Nurture Edu1"),
    (4, "J02_Nurture", "Prospect Nurture Journey", "Education Email 2",
     "nurturejourney_educationemail2",
     "Stage 4 — Nurture Edu Email 2 (J02)", "Stage 4 — Nurture Edu2"),
    (5, "J02_Nurture", "Prospect Nurture Journey", "Prospect Story Email",
     "nurturejourney_prospectstoryemail",
     "Stage 5 — Prospect Story Email (J02)", "Stage 5 — Prospect Story"),
    (6, "J03_Conversion", "High Engagement Conversion", "Conversion Email",
     "highengagement_conversionemail",
     "Stage 6 — Conversion Email (J03)", "Stage 6 — Conversion"),
    (7, "J03_Conversion", "High Engagement Conversion", "Reminder Email",
     "highengagement_reminderemail",
     "Stage 7 — Reminder Email (J03)", "Stage 7 — Reminder"),
    (8, "J04_ReEngagement", "Low Engagement Re-engagement", "Re-engagement Email",
     "lowengagement_reengagementemail",
     "Stage 8 — Re-engagement Email (J04)", "Stage 8 — Re-engagement"),
    (9, "J04_ReEngagement", "Low Engagement Re-engagement", "Final Reminder Email",
     "lowengagementfinalreminderemail",
     "Stage 9 — Final Reminder Email (J04)", "Stage 9 — Final Reminder"),
)
NO_STAGE = "No emails sent yet"

# Fixed values: (e-mail name, stage number).
EMAIL_STAGES = (
    ("Prospect_Welcome_01_Welcome_Email", 1),
    ("Prospect_Welcome_01_Welcome_Email_Resend", 1),
    ("Prospect_Welcome_02_Education_Email", 2),
    ("Prospect_Nurture_01_Education_Email_1", 3),
    ("Prospect_Nurture_01_Education_Email_1_Resend", 3),
    ("Prospect_Nurture_01_Education_Email_1 _Resend", 3),
    ("Prospect_Nurture_02_Education_Email_2", 4),
    ("Prospect_Nurture_03_Prospect_Story_Email", 5),
    ("Prospect_Nurture_03_Prospect_Story_Email_Resend", 5),
    ("Prospect_Nurture_03_Patient_Story_Email", 5),
    ("Prospect_Conversion_01_Conversion_Email", 6),
    ("Prospect_Conversion_02_Reminder_Email", 7),
    ("Prospect_ReEngagement_01_ReEngagement_Email", 8),
    ("Prospect_ReEngagement_02_Final_Reminder_Email", 9),
)

# Fixed values: (from stage, to stage, days to wait).
STAGE_WAITS = (
    (1, 2, 3), (2, 3, 5), (3, 4, 8), (4, 5, 3),
    (5, 6, 2), (6, 7, 2), (7, 8, 2), (8, 9, 2),
)

# Stages of each engagement path.
PATH_STAGES = {"HIGH": (1, 2, 3, 4, 5, 6, 7), "LOW": (8, 9)}

# --- channels and regions ---------------------------------------------------
# Channels counted as digital, and the seeded categories.
DIGITAL_CHANNELS = ("Instagram", "Facebook", "Website", "Campaign App", "Referral", "Survey")
SEED_CHANNELS = (
    ("Instagram", "Social Media"),
    ("Campaign App", "Web Campaign"),
    ("Facebook", "Social Media"),
    ("Website", "Web Campaign"),
    ("Referral", "Referral"),
)

# Census regions.
REGION_STATES = {
    "Northeast": ("CT", "ME", "MA", "NH", "RI", "VT", "NJ", "NY", "PA"),
    "Midwest": ("IL", "IN", "IA", "KS", "MI", "MN", "MO", "NE", "ND", "OH", "SD", "WI"),
    "South": ("AL", "AR", "DE", "FL", "GA", "KY", "LA", "MD", "MS", "NC", "OK", "SC",
              "TN", "TX", "VA", "WV", "DC"),
    "West": ("AZ", "CO", "ID", "MT", "NV", "NM", "UT", "WY", "AK", "CA", "HI", "OR", "WA"),
}

# Calendar seed.
CALENDAR_START = "2025-01-01"
CALENDAR_DAYS = 1096

# --- segment labels ---------------------------------------------------------
# Engagement segments, best first.
SEGMENT_HIGH = "High Engagement — Conversion Candidate"
SEGMENT_MID = "Mid Engagement — Nurture Needed"
SEGMENT_RISK = "At Risk — Drop-off Signal"
SEGMENT_LOW = "Low Engagement — Re-engagement Candidate"
SEGMENT_NONE = "No Activity"

# Funnel chart stages in order.
FUNNEL_CHART_STAGES = (
    "F01 Lead Intake", "F02 Valid Prospects", "F04 SFMC Sent", "F06 Opened", "F06 Clicked",
)
