"""ebbtide - subscriber-churn analytics on Spark DataFrames.

Every public function takes DataFrames (plus plain parameters) and returns a
DataFrame.  Nothing in the core path leaves the JVM.
"""
