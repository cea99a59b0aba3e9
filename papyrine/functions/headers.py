"""What kind of chapter a header announces: ordered rules, first match wins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Header texts (lower case) by the code they are given.
SPOILED = ["methodology and behavioral biometrics model", "new methodology for bathing"]
OTHER_PURPOSE = [
    "training methodology", "methodology participants", "benchmarking methodology",
    "assessment methodology", "optimization methodology", "validation methodology",
]
METHODOLOGY = [
    "methodology", "experiment methodology", "methodology and data", "design methodology", "analysis methodology",
    "proposed methodology", "data and methodology", "the proposed methodology", "methodology overview",
    "materials and methodology", "study methodology", "methodology of the study", "survey methodology",
    "methodology of research", "methodology and approach", "simulation methodology", "methodology description",
    "methodology and materials", "material and methodology", "methodology design", "methodology and design",
    "methodology and implementation", "methodology and experiments", "research and methodology",
    "background and methodology", "methodology and experimental setup", "general methodology",
    "design and methodology", "experimental setup and methodology", "system methodology",
    "methodology and procedures", "research questions and methodology", "methodology and methods",
    "methodology of the research", "working methodology", "proposed system methodology", "dataset and methodology",
    "theory and methodology", "setup and methodology", "methodology . overview of our network",
    "overall methodology", "problem formulation and methodology", "data & methodology", "solution methodology",
    "description of the methodology", "methodology and data collection", "methodology and analysis",
    "methodology and architecture", "methodology preliminaries", "methodology and research design",
    "methodology and setup", ". . . methodology", "classification methodology", "proposed system and methodology",
    "methodology and research methods", "methodology and data analysis", "methodology data collection",
    "methodology dataset", "methodology and process", "statistical methodology", "empirical methodology",
    "data collection and methodology", "overview of methodology", "user study methodology",
    "experimental methodology.", "methodology and procedure", "methods and methodology",
    "motivation and methodology", "methodology and framework", "investigation methodology",
    "methodology pipeline", "datasets and methodology", "methodology and system design", "methodology details",
    "proposal methodology", "proposed methodology:", "modeling methodology", "systematic review methodology",
    "model and methodology", "project methodology", "literature review methodology", "review methodology",
    "methodology research design", "research design and methodology", "methodology and results",
    "attack methodology", "methodology problem formulation", "tools and methodology",
    "systematic literature review methodology", "methodology and main results", "implementation methodology",
    "methodology of analysis", "methodology/materials", "methodology and dataset",
    "methodology and experimental results", "methodology summary", "approach and methodology",
    "methodology of experiments", "literature review and methodology", "problem statement and methodology",
    "programming methodology", "study methodology:", "applied methodology", "proposed design methodology",
    "methodology and tools", "objective and methodology", "development methodology", "computational methodology",
    "the methodology of the study", "data description and methodology", "methodology and model",
    "methodology adopted", "methodology implementation", "methodology of the proposed system",
    "methodology and model specification", "methodology datasets", "methodology of simulation",
    "scope and methodology", "methodology and architectures", "proof methodology",
    "methodology and theoretical framework", "the study methodology", "architecture and methodology",
    "research objectives and methodology", "methodology problem definition",
    "methodology research method and design", "methodology and scope", "workflow and methodology",
    "concept and working methodology", "objectives and methodology", "methodology and experimentation",
    "methodology and instruments", "methodology and research questions", "methodology perspective",
]

# Shortest chapter worth a code, longest header of the last rule.
MIN_CHAPTER_LENGTH = 100
MAX_SHORT_HEADER = 16


def classify_header(header: Column, header_length: Column, chapter_length: Column) -> Column:
    """Codes -4 .. -1 (set aside), 1 .. 7 (methodology, by rule), NULL (something else)."""
    text = F.lower(header)
    return (
        F.when(chapter_length.isNull() | (chapter_length < MIN_CHAPTER_LENGTH), -1)
        .when(text.isin(SPOILED), -2)
        .when(text.isin(OTHER_PURPOSE), -3)
        .when(text.contains("evaluation"), -4)
        .when(text.isin(METHODOLOGY), 1)
        .when(text.contains("research methodology"), 2)
        .when(text.startswith("methodology:"), 3)
        .when(text.endswith(": methodology"), 4)
        .when(text.contains("proposed methodology"), 5)
        .when(text.contains("experimental methodology"), 6)
        .when(text.contains("methodology") & (header_length <= MAX_SHORT_HEADER), 7)
    )
