"""Dictionaries, cue words, patterns and weights used by the default jobs.

Every job takes these as parameters (see ``Vocabulary``), so the same plans run
on any document domain.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values. They must stay as they are for results to match.
# ---------------------------------------------------------------------------

CANDIDATE_SECTIONS = {
    "skills": ("skills", "technical skills", "core skills", "technologies"),
    "education": ("education", "academic background"),
    "certifications": ("certifications", "certification", "licenses"),
    "projects": ("projects", "selected projects", "project experience"),
    "experience": ("experience", "work experience", "professional experience"),
}

JOB_SECTIONS = {
    "required_skills": ("required skills", "must have skills", "requirements"),
    "preferred_skills": ("preferred skills", "nice to have", "preferred qualifications"),
    "education": ("education", "education requirements"),
    "certifications": ("certifications", "certification requirements"),
    "responsibilities": ("responsibilities", "key responsibilities", "what you will do"),
    "qualifications": ("qualifications", "minimum qualifications"),
    "tools": ("tools", "platforms and tools"),
    "frameworks": ("frameworks", "libraries and frameworks"),
    "programming_languages": ("programming languages", "languages"),
}

CANDIDATE_SKILLS = (
    "Python", "SQL", "Machine Learning", "Deep Learning", "NLP",
    "Natural Language Processing", "Pandas", "NumPy", "scikit-learn", "TensorFlow",
    "PyTorch", "spaCy", "PyMuPDF", "AWS", "Azure", "Docker", "Kubernetes", "Git",
    "Linux", "Tableau", "Power BI", "Excel", "Java", "JavaScript", "React", "Django",
    "Flask", "FastAPI", "PostgreSQL", "MySQL", "MongoDB", "Airflow", "Spark", "Hadoop",
    "MLOps", "Statistics", "Data Visualization",
)

JOB_SKILLS = (
    "Python", "SQL", "Machine Learning", "Deep Learning", "NLP",
    "Natural Language Processing", "Pandas", "NumPy", "scikit-learn", "TensorFlow",
    "PyTorch", "spaCy", "PyMuPDF", "AWS", "Azure", "Docker", "Kubernetes", "Git",
    "Linux", "Tableau", "Power BI", "Excel", "Java", "JavaScript", "TypeScript", "React",
    "Django", "Flask", "FastAPI", "PostgreSQL", "MySQL", "MongoDB", "Airflow", "Spark",
    "Hadoop", "MLOps", "Statistics", "Data Visualization", "Terraform", "Jenkins",
    "Cyber Security", "SIEM", "Network Security",
)

PROGRAMMING_LANGUAGES = ("Python", "SQL", "Java", "JavaScript", "TypeScript", "Go", "Bash")

FRAMEWORKS = (
    "React", "Django", "Flask", "FastAPI", "TensorFlow", "PyTorch", "scikit-learn",
    "spaCy", "Spark",
)

TOOLS = (
    "AWS", "Azure", "Docker", "Kubernetes", "Git", "Linux", "Tableau", "Power BI",
    "Excel", "PostgreSQL", "MySQL", "MongoDB", "Airflow", "Hadoop", "Terraform",
    "Jenkins", "SIEM",
)

ROLE_WORDS = ("engineer", "analyst", "developer", "scientist", "intern", "manager", "lead")

CANDIDATE_CERTIFICATION_CUES = (
    "certified", "certificate", "certification", "aws", "azure", "google", "scrum",
    "tensorflow",
)

JOB_CERTIFICATION_CUES = (
    "certified", "certificate", "certification", "aws", "azure", r"security\+", "cissp",
    "kubernetes", "scrum", "tensorflow",
)

PROJECT_HEADING_CUES = (
    "project", "dashboard", "system", "pipeline", "classifier", "analysis", "platform",
    "service", "search", "toolkit",
)

PROJECT_LINE_CUES = ("project", "dashboard", "system", "pipeline", "classifier", "analysis")

NOT_A_NAME = ("resume", "curriculum", "email", "phone", "skills", "education")

EMAIL = r"[\w.+-]+@[\w-]+\.[\w.-]+"
PHONE = r"\(?\+?\d[\d\s().-]{7,}\d"
YEAR = r"\b(?:19|20)\d{2}\b"
YEAR_RANGE = r"\b((?:19|20)\d{2})\s*[-–]\s*((?:19|20)\d{2}|present)\b"
CANDIDATE_YEARS = r"(\d+(?:\.\d+)?)\+?\s*(?:years?|yrs?)\s+(?:of\s+)?experience"
JOB_YEARS = r"(\d+(?:\.\d+)?)\+?\s*(?:years?|yrs?)"
CANDIDATE_DEGREE = (
    r"\b(?:B\.?Tech|M\.?Tech|B\.?E\.?|M\.?E\.?|B\.?Sc|M\.?Sc|Bachelor(?:'s)?|"
    r"Master(?:'s)?|MBA|Ph\.?D\.?|Doctorate)[^\n,;]*"
)
JOB_DEGREE = (
    r"\b(?:B\.?Tech|M\.?Tech|B\.?E\.?|M\.?E\.?|B\.?Sc|M\.?Sc|Bachelor(?:'s)?|"
    r"Master(?:'s)?|MBA|Ph\.?D\.?|Doctorate|degree)\b[^.\n]*"
)

# What field values are stripped of, a word of a name, and what separates the parts of a line.
FIELD_EDGES = " -,:;"
PHONE_EDGES = " |,;"
NAME_WORD = "[A-Za-z][A-Za-z'.-]*"
INSTITUTION_BREAK = r"\s{2,}|\||,"
ISSUER_BREAK = r"\s+-\s+|\s+\|\s+|,"

# A dictionary term must not touch one of these characters on either side.
TERM_CHARS = "A-Za-z0-9+#.-"

# Degree term -> what a job text must contain for the term to count.
DEGREE_EQUIVALENTS = {
    "ph.d": ("ph.d", "doctorate"),
    "doctorate": ("doctorate", "ph.d"),
    "master": ("master",),
    "m.sc": ("m.sc", "master"),
    "m.tech": ("m.tech", "master"),
    "bachelor": ("bachelor", "degree"),
    "b.sc": ("b.sc", "bachelor", "degree"),
    "b.tech": ("b.tech", "bachelor", "degree"),
    "degree": ("degree",),
}

TARGET_WEIGHTS = {
    "semantic_similarity": 0.40,
    "skill_match_percentage": 0.20,
    "experience_match_score": 0.15,
    "education_match_score": 0.10,
    "certification_match_score": 0.05,
    "programming_language_match": 0.05,
    "framework_match": 0.03,
    "tools_match": 0.02,
}

LABEL_NOISE_SIGMA = 2.0
CONFIDENCE_SPREAD_FACTOR = 3.0
CONFIDENCE_WITHOUT_TREES = 75.0

ASSESSMENT_BANDS = (
    (85.0, "Excellent Match"),
    (70.0, "Strong Match"),
    (55.0, "Moderate Match"),
    (40.0, "Weak Match"),
    (None, "Poor Match"),
)
INTERVIEW_BANDS = (
    (80.0, "Highly Recommended"),
    (65.0, "Recommended"),
    (50.0, "Consider"),
    (None, "Not Recommended"),
)
SCORE_LABELS = ((0.75, "high"), (0.50, "moderate"), (None, "low"))

# Review rules in output order.
# (feature, reaches, stays below or None, text)
STRENGTHS = (
    ("semantic_similarity", 0.75, None, "Strong semantic similarity with the job description"),
    ("semantic_similarity", 0.65, 0.75, "Good semantic similarity with the job description"),
    ("skill_match_percentage", 0.70, None, "Strong match against required and preferred skills"),
    ("experience_match_score", 0.80, None, "High experience match for the role"),
    ("education_match_score", 0.80, None, "Relevant education for the role"),
    ("certification_match_score", 0.80, None, "Relevant certifications are present"),
    ("project_relevance_score", 0.60, None, "Relevant projects align with job requirements"),
    ("programming_language_match", 0.70, None, "Good programming language match"),
    ("framework_match", 0.70, None, "Good framework match"),
    ("tools_match", 0.70, None, "Good tools and platform match"),
)
MISSING_SKILLS = "Missing required skills: "
# (required flag or None, feature, comparison, bound, text)
WEAKNESSES = (
    (None, "skill_match_percentage", "<", 0.50, "Overall skill match is low"),
    (None, "experience_match_score", "<", 0.70, "Experience match is below the role requirement"),
    ("has_education", "education_match_score", "<", 0.50,
     "Education alignment is limited or not clearly stated"),
    ("has_certification", "certification_match_score", "<=", 0.0,
     "Relevant certification match was not identified"),
    ("has_language", "programming_language_match", "<", 0.50, "Programming language match is limited"),
    ("has_framework", "framework_match", "<=", 0.0,
     "Framework experience is missing or not clearly stated"),
    ("has_tool", "tools_match", "<=", 0.0, "Tools or cloud technology match is missing"),
    (None, "project_relevance_score", "<", 0.40, "Project relevance to the role is limited"),
)
ADD_SKILL = ("Add ", " if you have hands-on experience.")
RECOMMENDATIONS = (
    (None, "project_relevance_score", "<", 0.60,
     "Highlight projects that directly use the role's key skills."),
    ("has_tool", "tools_match", "<", 0.50,
     "Mention relevant tools, cloud platforms, and deployment work."),
    ("has_framework", "framework_match", "<", 0.50,
     "Add framework experience that matches the job description."),
    ("has_language", "programming_language_match", "<", 0.50,
     "Emphasize programming languages requested by the role."),
    (None, "experience_match_score", "<", 0.80, "Clarify total years of relevant experience."),
    (None, "semantic_similarity", "<", 0.65,
     "Align resume wording more closely with the job requirements."),
    (None, "skill_match_percentage", "<", 0.70,
     "Move the most relevant skills into a clear skills section."),
)
SUMMARY_SCORE = ("The candidate is a ", " with an overall score of ", ".")
SUMMARY_SIMILARITY = ("Semantic similarity is ", " at ", ", and skill match is ", ".")
SUMMARY_MATCHED = ("Matched skills include ", ".")
SUMMARY_GAPS = ("The main gaps are ", ".")
NO_GAPS = "No required skill gaps were identified from the parsed data."
REPORT_TITLE = "Resume Review Report"
REPORT_RULE = "========================================================="
REPORT_HEADINGS = (
    "Candidate Name", "Job Title", "Overall Candidate Score", "Overall Assessment",
    "Section 1\nSummary", "Section 2\nStrengths", "Section 3\nWeaknesses",
    "Section 4\nMatched Skills", "Section 5\nMissing Skills", "Section 6\nDetailed Scores",
    "Section 7\nRecommendations", "Section 8\nInterview Recommendation",
)
REPORT_DETAILS = (
    ("Semantic Similarity", "semantic_similarity"),
    ("Skill Match", "skill_match_percentage"),
    ("Experience Match", "experience_match_score"),
    ("Education Match", "education_match_score"),
    ("Certification Match", "certification_match_score"),
    ("Programming Languages", "programming_language_match"),
    ("Frameworks", "framework_match"),
    ("Tools", "tools_match"),
    ("Project Relevance", "project_relevance_score"),
)

# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Vocabulary:
    """The dictionaries one parsing run works with; defaults are the fixed lists."""

    candidate_sections: dict = field(default_factory=lambda: CANDIDATE_SECTIONS)
    job_sections: dict = field(default_factory=lambda: JOB_SECTIONS)
    candidate_skills: tuple = CANDIDATE_SKILLS
    job_skills: tuple = JOB_SKILLS
    programming_languages: tuple = PROGRAMMING_LANGUAGES
    frameworks: tuple = FRAMEWORKS
    tools: tuple = TOOLS
    role_words: tuple = ROLE_WORDS
    candidate_certification_cues: tuple = CANDIDATE_CERTIFICATION_CUES
    job_certification_cues: tuple = JOB_CERTIFICATION_CUES
    project_heading_cues: tuple = PROJECT_HEADING_CUES
    project_line_cues: tuple = PROJECT_LINE_CUES
    not_a_name: tuple = NOT_A_NAME


DEFAULT = Vocabulary()
