"""limelight: artist scouting on Spark DataFrames."""
