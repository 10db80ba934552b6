"""Fixed values of the domain: words by which names are recognised, and what they stand for."""

from __future__ import annotations

#: Words in intervention names and the pattern they name.
PATTERN_WORDS = {
    "neuropsychological": ("ssri", "therapy", "meditation", "counseling", "antidepressant", "anxiolytic"),
    "gut_microbiome": ("probiotic", "prebiotic", "fiber", "fodmap", "fermented", "microbiome"),
    "metabolic": ("metformin", "insulin", "glucose", "diet", "low_carb", "ketogenic"),
    "inflammatory": ("anti_inflammatory", "nsaid", "omega_3", "turmeric", "curcumin"),
    "hormonal": ("hormone", "estrogen", "testosterone", "thyroid", "cortisol"),
    "cardiovascular": ("beta_blocker", "ace_inhibitor", "statin", "cardio", "heart"),
    "immune": ("immunosuppressant", "vaccine", "antibody", "immune", "autoimmune"),
    "musculoskeletal": ("physical_therapy", "exercise", "strength", "mobility", "joint"),
}
#: What bears on each body function.
FUNCTION_PATTERNS = {
    "inflammation": (("arthritis", "ibs", "crohns", "autoimmune", "inflammatory_bowel_disease", "psoriasis"), ("anti_inflammatory", "omega_3", "turmeric", "curcumin", "cold_exposure"), ("inflammatory", "immune", "gut_microbiome")),
    "stress_response": (("anxiety", "depression", "insomnia", "hypertension", "ibs", "chronic_pain"), ("meditation", "yoga", "breathing", "mindfulness", "therapy"), ("neuropsychological", "cardiovascular", "gut_microbiome")),
    "cellular_metabolism": (("diabetes", "obesity", "metabolic_syndrome", "pcos", "fatigue"), ("exercise", "intermittent_fasting", "cold_exposure", "metformin"), ("metabolic", "cardiovascular", "neuropsychological")),
    "microbiome_regulation": (("ibs", "depression", "anxiety", "autoimmune", "allergies"), ("probiotics", "fiber", "fermented_foods", "prebiotics"), ("gut_microbiome", "neuropsychological", "immune")),
    "circadian_rhythm": (("insomnia", "depression", "metabolic_syndrome", "fatigue"), ("light_therapy", "sleep_hygiene", "melatonin", "exercise"), ("neuropsychological", "metabolic", "hormonal")),
    "autonomic_nervous_system": (("anxiety", "hypertension", "arrhythmia", "ibs", "chronic_pain"), ("breathing_exercises", "cold_exposure", "meditation", "vagus_nerve_stimulation"), ("neuropsychological", "cardiovascular", "gut_microbiome")),
}
#: Words in condition names by field.
FIELD_WORDS = {
    "mental": ("depression", "anxiety", "mood", "stress"),
    "gut": ("ibs", "gut", "digestive", "microbiome", "sibo"),
    "inflammatory": ("arthritis", "inflammation", "autoimmune", "psoriasis"),
    "metabolic": ("diabetes", "metabolic", "insulin", "pcos"),
}
#: What a pair of fields is a discovery of, then what a pair of leading mechanisms is.
FIELD_DISCOVERIES = (("mental", "gut", "gut_brain_axis"), ("mental", "inflammatory", "inflammation_mood_connection"), ("mental", "metabolic", "metabolic_mental_health"))
MECHANISM_DISCOVERIES = (("gut_microbiome", "neuropsych", "gut_brain_axis"), ("inflammation", "neuropsych", "inflammation_mood_connection"), ("metabolic", "stress_response", "metabolic_stress_axis"))
#: Names of a cluster by its leading mechanism.
CLUSTER_NAMES = {
    "neuropsych": "Neuropsych", "gut_microbiome": "Gut", "inflammation": "Inflammatory", "metabolic": "Metabolic", "stress_response": "Stress", "neurotransmitter": "Neurotransmitter",
    "hormonal": "Hormonal", "cardiovascular": "Cardiovascular", "pain_management": "Pain", "detoxification": "Detox",
}
#: Interventions that are hard or easy to study.
HARD_TO_STUDY = ("stem_cell_therapy", "gene_therapy", "psychedelics")
EASY_TO_STUDY = ("meditation", "exercise", "weighted_blankets", "light_therapy")
