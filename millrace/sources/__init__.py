"""Where events come from: schedules, files, message tables, request logs."""
