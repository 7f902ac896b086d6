"""Default word lists of the text operators. Each one is a parameter of the operator that uses it."""

from __future__ import annotations

# --- Fixed values: abbreviations -----------------------------------------------------------------

NOTE_ABBREVIATIONS = {
    "pt": "patient",
    "dx": "diagnosis",
    "hx": "history",
    "rx": "prescription",
    "sx": "symptoms",
    "tx": "treatment",
    "bp": "blood pressure",
    "hr": "heart rate",
    "rr": "respiratory rate",
    "sob": "shortness of breath",
    "nkda": "no known drug allergies",
    "prn": "as needed",
    "bid": "twice daily",
    "tid": "three times daily",
    "qid": "four times daily",
    "po": "by mouth",
    "iv": "intravenous",
    "im": "intramuscular",
    "htn": "hypertension",
    "dm": "diabetes mellitus",
    "chf": "congestive heart failure",
    "copd": "chronic obstructive pulmonary disease",
    "cad": "coronary artery disease",
    "uti": "urinary tract infection",
    "bmp": "basic metabolic panel",
    "cbc": "complete blood count",
    "ct": "computed tomography",
    "mri": "magnetic resonance imaging",
}

# --- Fixed values: entity word lists (matched as whole words, any case) --------------------------

MEDICATIONS = [
    "aspirin", "metformin", "lisinopril", "atorvastatin", "amlodipine", "omeprazole", "metoprolol", "losartan",
    "albuterol", "gabapentin", "hydrochlorothiazide", "acetaminophen", "ibuprofen", "amoxicillin",
    "prednisone", "insulin", "warfarin", "heparin", "clopidogrel", "furosemide", "levothyroxine",
    "pantoprazole", "sertraline", "fluoxetine", "ciprofloxacin", "azithromycin", "doxycycline", "morphine",
    "fentanyl", "vancomycin", "ceftriaxone",
]
DIAGNOSES = [
    "diabetes", "hypertension", "pneumonia", "sepsis", "COPD", "asthma", "heart failure",
    "myocardial infarction", "stroke", "anemia", "cirrhosis", "hepatitis", "renal failure", "cancer", "tumor",
    "malignancy", "infection", "fracture", "embolism", "thrombosis", "fibrillation", "cardiomyopathy",
    "pancreatitis", "meningitis", "encephalitis",
]
PROCEDURES = [
    "intubation", "ventilation", "catheterization", "biopsy", "dialysis", "transfusion", "surgery", "resection",
    "endoscopy", "colonoscopy", "bronchoscopy", "angiography", "echocardiogram", "MRI", "CT scan", "X-ray",
    "ultrasound", "EKG", "ECG", "lumbar puncture", "thoracentesis", "paracentesis", "tracheostomy",
]
ANATOMY = [
    "lung", "liver", "kidney", "heart", "brain", "spleen", "pancreas", "stomach", "colon", "esophagus",
    "bladder", "prostate", "thyroid", "adrenal", "pituitary", "femur", "tibia", "spine", "vertebra", "aorta",
    "vein", "artery", "bronchus", "trachea", "pleura",
]
ENTITY_LEXICONS = {
    "medication_count": MEDICATIONS,
    "diagnosis_count": DIAGNOSES,
    "procedure_count": PROCEDURES,
    "anatomy_count": ANATOMY,
}
DRUGS = [
    "lisinopril", "amlodipine", "losartan", "metoprolol", "atenolol", "carvedilol", "valsartan", "diltiazem",
    "hydralazine", "furosemide", "hydrochlorothiazide", "spironolactone", "warfarin", "clopidogrel", "aspirin",
    "heparin", "enoxaparin", "atorvastatin", "simvastatin", "rosuvastatin", "metformin", "glipizide",
    "insulin", "sitagliptin", "empagliflozin", "liraglutide", "pioglitazone", "levothyroxine", "albuterol",
    "fluticasone", "montelukast", "ipratropium", "budesonide", "prednisone", "dexamethasone", "ibuprofen",
    "acetaminophen", "naproxen", "morphine", "hydrocodone", "oxycodone", "tramadol", "gabapentin",
    "pregabalin", "celecoxib", "amoxicillin", "azithromycin", "ciprofloxacin", "doxycycline", "metronidazole",
    "ceftriaxone", "vancomycin", "piperacillin", "trimethoprim", "levofloxacin", "clindamycin", "omeprazole",
    "pantoprazole", "ondansetron", "famotidine", "sertraline", "fluoxetine", "escitalopram", "duloxetine",
    "lorazepam", "diazepam", "alprazolam", "quetiapine", "levetiracetam", "phenytoin",
]

# --- Fixed values: severity keywords and negation cues (matched as substrings) -------------------

CRITICAL_WORDS = [
    "critical", "emergent", "acute", "severe", "unstable", "deteriorating", "shock", "arrest", "unresponsive",
    "intubated", "septic", "hemorrhage", "code blue", "stat", "life-threatening", "respiratory failure",
    "cardiac arrest", "comatose",
]
BENIGN_WORDS = [
    "stable", "improving", "resolved", "normal", "unremarkable", "benign", "routine", "discharged", "ambulatory",
    "alert", "oriented", "well-appearing", "afebrile", "no complaints",
]
NEGATION_CUES = [
    "no ", "not ", "denies ", "denied ", "negative for ", "without ", "absence of ", "does not have ",
    "no evidence of ", "rules out ", "ruled out ", "free of ",
]

# --- Fixed values: stop words of the frequent-term report ----------------------------------------

STOP_WORDS = [
    "the", "a", "an", "is", "was", "are", "were", "be", "been", "being", "have", "has", "had", "do", "does",
    "did", "will", "would", "could", "should", "may", "might", "shall", "can", "to", "of", "in", "for", "on",
    "with", "at", "by", "from", "as", "into", "through", "during", "and", "but", "or", "nor", "not", "so",
    "yet", "both", "either", "neither", "each", "every", "all", "any", "few", "more", "most", "other", "some",
    "such", "no", "only", "own", "same", "than", "too", "very", "just", "because", "this", "that", "these",
    "those", "it", "its", "he", "she", "they", "them", "his", "her", "their", "patient", "also", "which",
    "who", "whom", "what", "where", "when",
]
