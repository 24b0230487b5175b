"""Fixed domain vocabulary: catalogues, ranges, label maps, rule thresholds."""

from __future__ import annotations

# Event and session catalogues and their spelling variants.
EVENT_TYPES = ["recurso", "tarea", "foro", "cuestionario"]
EVENT_TYPE_MAP = {"resource": "recurso", "task": "tarea", "forum": "foro", "quiz": "cuestionario"}
SESSION_RESULTS = ["completada", "no_asistio", "reprogramada"]
SESSION_RESULT_MAP = {"completed": "completada", "no asistio": "no_asistio",
                      "no-asistio": "no_asistio", "rescheduled": "reprogramada"}
SESSION_MODES = ["presencial", "virtual"]
SESSION_TOPICS = ["rendimiento_academico", "asistencia", "tecnicas_estudio",
                  "orientacion_personal"]
ALERT_STATES = ["abierta", "en_seguimiento", "cerrada"]
ALERT_LEVELS = ["bajo", "medio", "alto"]
NOTE_CATEGORIES = ["academico", "asistencia", "familiar", "conducta", "motivacion",
                   "indeterminada"]
PERIOD_CODES = ["P1", "P2", "P3"]
SUBJECTS = {"MAT": "Matemáticas", "POR": "Lengua Portuguesa"}
SCHOOLS = {"GP": "Gabriel Pereira", "MS": "Mousinho da Silveira"}
MAX_MINUTES = 240
PASS_MARK = 10
MAX_GRADE = 20
MIN_AGREEMENT = 12

# The 33 register columns with their domains.
YES_NO = ["schoolsup", "famsup", "paid", "activities", "nursery", "higher", "internet", "romantic"]
NOMINAL_DOMAINS = {
    "school": ["GP", "MS"],
    "sex": ["F", "M"],
    "address": ["U", "R"],
    "famsize": ["LE3", "GT3"],
    "Pstatus": ["T", "A"],
    "Mjob": ["teacher", "health", "services", "at_home", "other"],
    "Fjob": ["teacher", "health", "services", "at_home", "other"],
    "reason": ["home", "reputation", "course", "other"],
    "guardian": ["mother", "father", "other"],
    **{c: ["yes", "no"] for c in YES_NO},
}
NUMERIC_DOMAINS = {
    "age": (15, 22), "Medu": (0, 4), "Fedu": (0, 4), "traveltime": (1, 4), "studytime": (1, 4),
    "failures": (0, 3), "famrel": (1, 5), "freetime": (1, 5), "goout": (1, 5), "Dalc": (1, 5),
    "Walc": (1, 5), "health": (1, 5), "absences": (0, 93), "G1": (0, 20), "G2": (0, 20),
    "G3": (0, 20),
}
REGISTER_COLUMNS = [
    "school", "sex", "age", "address", "famsize", "Pstatus", "Medu", "Fedu", "Mjob", "Fjob",
    "reason", "guardian", "traveltime", "studytime", "failures", "schoolsup", "famsup", "paid",
    "activities", "nursery", "higher", "internet", "romantic", "famrel", "freetime", "goout",
    "Dalc", "Walc", "health", "absences", "G1", "G2", "G3",
]
IDENTITY_KEY = ["school", "sex", "age", "address", "famsize", "Pstatus", "Medu", "Fedu", "Mjob",
                "Fjob", "reason", "nursery", "internet"]
PERSONAL_ATTRIBUTES = ["guardian", "traveltime", "studytime", "schoolsup", "famsup", "activities",
                       "higher", "romantic", "famrel", "freetime", "goout", "Dalc", "Walc",
                       "health"]

# Target names and labels of the student table.
STUDENT_COLUMNS = {
    "sex": "sexo", "age": "edad", "address": "zona", "famsize": "tamano_familia",
    "Pstatus": "estado_padres", "Medu": "educ_madre", "Fedu": "educ_padre",
    "Mjob": "trabajo_madre", "Fjob": "trabajo_padre", "reason": "motivo_eleccion",
    "guardian": "tutor_legal", "traveltime": "tiempo_viaje", "studytime": "tiempo_estudio",
    "schoolsup": "apoyo_escolar", "famsup": "apoyo_familiar", "activities": "actividades",
    "nursery": "guarderia", "higher": "desea_superior", "internet": "internet",
    "romantic": "relacion_romantica", "famrel": "relacion_familiar", "freetime": "tiempo_libre",
    "goout": "salidas", "Dalc": "alcohol_semana", "Walc": "alcohol_finde", "health": "salud",
}
_JOBS = {"teacher": "docente", "health": "salud", "services": "servicios", "at_home": "hogar",
         "other": "otro"}
LABELS = {
    "zona": {"U": "Urbana", "R": "Rural"},
    "tamano_familia": {"LE3": "<=3", "GT3": ">3"},
    "estado_padres": {"T": "Juntos", "A": "Separados"},
    "trabajo_madre": _JOBS,
    "trabajo_padre": _JOBS,
    "motivo_eleccion": {"home": "cercania", "reputation": "reputacion", "course": "oferta",
                        "other": "otro"},
    "tutor_legal": {"mother": "madre", "father": "padre", "other": "otro"},
}
