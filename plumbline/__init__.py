"""plumbline: relational record, timetable and document analytics as DataFrame-to-DataFrame operators."""
