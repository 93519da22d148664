"""Fixed values.

Codes, labels, thresholds and message texts that a result has to carry exactly as
written here. Nothing in this module is computed.
"""

# Source (app) whose sessions, steps and calories count; the other tables take every source.
WATCH_SOURCE_ID = 4

# Thresholds.
MIN_SLEEP_HOURS = 0.5
MAX_RESTING_BPM = 100
MIN_SPO2_PERCENT = 85

# Sleep stage codes.
STAGE_AWAKE = 1
STAGE_LIGHT = 4
STAGE_DEEP = 5
STAGE_REM = 6

# Exercise codes and their labels.
EXERCISE_LABELS = {45: "Fuerza", 53: "Running", 58: "Senderismo", 5: "Otro"}
OTHER_EXERCISE = "Otro"
REST_DAY = "Descanso"

# Weekday names, Monday first.
WEEKDAY_NAMES = ["Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo"]

# Report symbols.
WEEKDAY_SYMBOL = "🔵"
WEEKEND_SYMBOL = "🟡"
WEEKEND_NAMES = ["Sábado", "Domingo"]
WORKOUT_SYMBOLS = {
    "Fuerza": "💪",
    "Running": "🏃",
    "Senderismo": "🥾",
    "Descanso": "😴",
    "Otro": "🏋️",
}
DEFAULT_WORKOUT_SYMBOL = "😴"

# Report texts; {names} are filled per row.
ABSENT = "-"
NO_READING = "sin datos"
NOT_AVAILABLE = "N/A"
DAY_TABLE_TITLE = "📅 RESUMEN DÍA A DÍA\n"
DAY_BLOCK = (
    "{day_symbol} {dia} ({fecha})\n"
    "   💤 Sueño: {sleep_h}h  |  🧠 Profundo: {deep_min}min  |  🌀 REM: {rem_min}min\n"
    "   🚶 Pasos: {steps}  |  🔥 Kcal: {kcal}\n"
    "   {workout_symbol} Entreno: {workout} — {w_min}min\n"
    "   ❤️ FC reposo: {hr}  |  🩸 SpO2: {spo2}\n"
)
SUMMARY_BLOCK = (
    "DATOS DE LA SEMANA ({fecha_inicio} → {fecha_fin})\n"
    "\n"
    "{tabla}\n"
    "\n"
    "ESTADÍSTICAS:\n"
    "- Total pasos: {total_steps}\n"
    "- Días de entrenamiento: {training_days}/7\n"
    "- Total minutos entrenados: {training_minutes}\n"
    "- Media sueño/noche: {avg_sleep}h\n"
    "- Media sueño profundo/noche: {avg_deep}min\n"
    "- Media FC reposo: {avg_hr} bpm\n"
    "\n"
    "SEMANA ANTERIOR:\n"
    "- Media pasos: {prior_avg_steps}\n"
    "- Media sueño: {prior_avg_sleep}h\n"
)
WEEK_MESSAGE = "📊 INFORME SEMANAL\n{fecha_inicio} → {fecha_fin}\n\n{tabla}"
ANALYSIS_MESSAGE = "🤖 ANÁLISIS EXPERTO\n\n{analysis}"

# Longest message part, in characters.
MESSAGE_SIZE = 4000

# Raw tables of an export.
RAW_TABLES = [
    "sleep_session_record_table",
    "sleep_stages_table",
    "steps_record_table",
    "active_calories_burned_record_table",
    "exercise_session_record_table",
    "resting_heart_rate_record_table",
    "oxygen_saturation_record_table",
    "weight_record_table",
]
