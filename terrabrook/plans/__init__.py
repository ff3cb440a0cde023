"""terrabrook.plans"""
