"""The texts the assistant answers with."""

# Fixed values
NOT_REGISTERED = "❌ Your number is not registered with the school."
SELECTED = "✅ Selected {name}. How can I help?"
MENU_HEADING = "You have multiple children:"
SUMMARY_STARTED = "⏳ Fetching detailed summary for you…"
PLAN_STARTED = "⏳ Creating an improvement plan…"
ATTENDANCE = "📊 Attendance this week: {attendance}%"
NO_HOMEWORK = "📘 No homework assigned today."
NO_GRADES = "📊 No grades available."
GREETING = (
    "Hello! 👋 You can ask:\n"
    "- How is my child doing?\n"
    "- Suggest improvement plan\n"
    "- Attendance this week\n"
    "- Homework\n"
    "- Grades"
)
HELP = "I can help with attendance, homework, grades, or summaries."
DIGEST_HEADING = "Attendance: {attendance}%"
DEFAULT_PLAN = (
    "Here are some general improvement suggestions:\n"
    "- Encourage regular attendance\n"
    "- Ensure homework is completed daily\n"
    "- Spend time revising Maths and English\n"
    "- Communicate with the class teacher"
)
